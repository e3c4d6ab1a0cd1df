"""Gold from a running state: one day's Silver rows are merged, history is not read again.

The state of a valuation date holds partial aggregates:

* ``claims``    one row per claim: its latest version, payments counted and summed,
  the least and greatest policy of its versions, first payment and first expense day;
* ``policies``  one row per policy: latest attributes, premium and exposure so far;
* ``expenses``  sums and counts per scope, category, region, currency and policy;
* ``seen``      key and digest of every claim version, payment and expense, appended
  per day.

A record sent again on a later day is known by its digest and counts once; the same
key with another digest is a conflict (G1).  All other checks need only the day's
records and the merged claims.  Each merge is one aggregation over the state and the
day, so a backfill costs (state + day) per date instead of the whole window; only the
key and digest columns of ``seen`` are read back.

The window's end needs no stored dates: the checks refuse expenses and claims of the
future, so what was merged up to a date lies inside that date's window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import date_lit, money
from ..schemas import EXPENSE_FIELDS, GOLD_CLAIM_FIELDS, GOLD_EXPOSURE_FIELDS, PAYMENT_FIELDS
from . import gold
from .checks import Check

EXPENSE_KEYS = ["expense_scope", "expense_category", "region", "currency", "policy_id"]
ATTRIBUTES = ["region", "customer_segment", "age_band"]
RECORD_KEYS = {
    "claims_events": (GOLD_CLAIM_FIELDS, ["claim_id", "source_version"]),
    "claim_payments": (PAYMENT_FIELDS, ["payment_id"]),
    "expense_transactions": (EXPENSE_FIELDS, ["expense_id"]),
}


@dataclass
class GoldState:
    claims: DataFrame
    policies: DataFrame
    expenses: DataFrame
    seen: DataFrame


@dataclass
class Merge:
    """The state after a day, the rows it adds to ``seen`` and what the day violates."""

    state: GoldState
    seen_today: DataFrame
    checks: list[Check]


def _identified(df: DataFrame, dataset: str) -> DataFrame:
    """Distinct business records of a dataset with their digest (the first 16 bytes of a SHA-256).
    They are dealt out by the digest, where copies and what the state has seen meet."""
    columns, _ = RECORD_KEYS[dataset]
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    digest = F.substring(F.unhex(F.sha2(text, 256)), 1, 16)
    return df.select(*columns, digest.alias("_digest")).repartition("_digest").dropDuplicates()


def _key(dataset: str) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in RECORD_KEYS[dataset][1]])


def _new_records(day: DataFrame, dataset: str, seen: DataFrame | None) -> tuple[DataFrame, Check | None]:
    """Records of the day that the state does not hold, and keys it holds with another record."""
    records = _identified(day, dataset)
    if seen is None:
        return records, None
    known = seen.where(F.col("dataset") == dataset)
    new = records.join(known.select(F.col("digest").alias("_digest")), "_digest", "left_anti")
    clash = new.withColumn("_key", _key(dataset)).join(known.select(F.col("key").alias("_key")), "_key", "left_semi")
    return new, Check(f"{dataset}: conflicting business records for the same key", clash, ["_key"])


def _merged_claims(state: DataFrame | None, claims: DataFrame, payments: DataFrame, expenses: DataFrame) -> DataFrame:
    latest_first = ["source_version", "source_updated_at"]  # the greatest record is the latest version
    record = F.struct(*latest_first, *[c for c in GOLD_CLAIM_FIELDS if c not in ("claim_id", *latest_first)])
    versions = claims.select(
        "claim_id", record.alias("record"),
        F.col("policy_id").alias("first_policy"), F.col("policy_id").alias("last_policy"))
    paid = payments.select("claim_id", F.lit(1).cast("bigint").alias("payment_count"), F.col("amount").cast("decimal(28,2)").alias("ledger_paid"),
                           F.col("payment_date").alias("first_payment"))
    spent = expenses.where("expense_scope = 'CLAIM'").select("claim_id", F.col("expense_date").alias("first_expense"))
    rows = versions.unionByName(paid, allowMissingColumns=True).unionByName(spent, allowMissingColumns=True)
    if state is not None:
        held = F.col("source_version").isNotNull() | F.col("policy_id").isNotNull()
        rows = rows.unionByName(state.select(
            "claim_id", F.when(held, record).alias("record"), "first_policy", "last_policy",
            "payment_count", "ledger_paid", "first_payment", "first_expense"))
    merged = rows.groupBy(F.col("claim_id").alias("_claim")).agg(
        F.max("record").alias("record"),
        F.min("first_policy").alias("first_policy"), F.max("last_policy").alias("last_policy"),
        F.sum("payment_count").alias("payment_count"), F.sum("ledger_paid").cast("decimal(28,2)").alias("ledger_paid"),
        F.min("first_payment").alias("first_payment"), F.min("first_expense").alias("first_expense"))
    return merged.select(F.col("_claim").alias("claim_id"), *[F.col(f"record.{c}").alias(c) for c in GOLD_CLAIM_FIELDS if c != "claim_id"],
                         "first_policy", "last_policy", "payment_count", "ledger_paid", "first_payment", "first_expense")


def _merged_policies(state: DataFrame | None, exposure: DataFrame) -> DataFrame:
    rows = exposure.select("policy_id", "load_date", F.struct(*ATTRIBUTES).alias("attrs"),
                           F.col("earned_premium").cast("decimal(28,4)"), F.col("earned_exposure").cast("decimal(28,8)"))
    if state is not None:
        rows = rows.unionByName(state.select("policy_id", "load_date", F.struct(*ATTRIBUTES).alias("attrs"), "earned_premium", "earned_exposure"))
    return rows.groupBy("policy_id").agg(
        F.max_by("attrs", "load_date").alias("attrs"), F.max("load_date").alias("load_date"),
        F.sum("earned_premium").cast("decimal(28,4)").alias("earned_premium"),
        F.sum("earned_exposure").cast("decimal(28,8)").alias("earned_exposure")).select(
        "policy_id", "load_date", "attrs.*", "earned_premium", "earned_exposure")


def _merged_expenses(state: DataFrame | None, expenses: DataFrame, start: str) -> DataFrame:
    direct = F.when(F.col("expense_scope").isin("CLAIM", "POLICY"), F.col("policy_id"))
    rows = expenses.where(F.col("expense_date") >= date_lit(start)).select(
        *[c for c in EXPENSE_KEYS if c != "policy_id"], direct.alias("policy_id"),
        F.col("amount").cast("decimal(28,2)"), F.lit(1).cast("bigint").alias("transaction_count"))
    if state is not None:
        rows = rows.unionByName(state)
    return rows.groupBy(*EXPENSE_KEYS).agg(F.sum("amount").cast("decimal(28,2)").alias("amount"),
                                           F.sum("transaction_count").alias("transaction_count"))


def advance(state: GoldState | None, day: dict[str, DataFrame], start: str, end: str,
            hold: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> Merge:
    """``state`` (None: nothing yet) with the Silver rows of further load dates merged in, up to ``end``.

    ``hold`` may write a frame and read it back: the day's new records and the merged tables are used
    by many checks and tables each."""
    seen = state and state.seen
    claims, claim_clash = _new_records(day["claims_events"], "claims_events", seen)
    payments, payment_clash = _new_records(day["claim_payments"], "claim_payments", seen)
    expenses, expense_clash = _new_records(day["expense_transactions"], "expense_transactions", seen)
    claims, payments, expenses = hold(claims, "new_claims"), hold(payments, "new_payments"), hold(expenses, "new_expenses")
    exposure = gold.distinct_records(day["daily_exposure"], GOLD_EXPOSURE_FIELDS)
    after = GoldState(
        claims=hold(_merged_claims(state and state.claims, claims, payments, expenses), "state_claims"),
        policies=hold(_merged_policies(state and state.policies, exposure), "state_policies"),
        expenses=hold(_merged_expenses(state and state.expenses, expenses, start), "state_expenses"),
        seen=seen)
    today = [df.select(F.lit(name).alias("dataset"), _key(name).alias("key"), F.col("_digest").alias("digest"))
             for name, df in (("claims_events", claims), ("claim_payments", payments), ("expense_transactions", expenses))]
    return Merge(after, today[0].union(today[1]).union(today[2]), [
        *[c for c in (claim_clash, payment_clash, expense_clash) if c],
        *gold.gold_checks(gold.Resolved(claims, after.claims.where("source_version IS NOT NULL"), exposure, payments, expenses), start, end),
        *_checks_across_days(after.claims)])


def _checks_across_days(claims: DataFrame) -> list[Check]:
    """What a day can break in records of earlier days."""
    c = F.col
    return [
        Check("Claim changes policy across versions", claims.where(c("first_policy") != c("last_policy")), ["claim_id"], "last_policy"),
        Check("Payment claim/policy/date mismatch",
              claims.where((c("first_payment") < c("reported_date")) | (c("first_payment") < c("incident_date"))), ["claim_id"]),
        Check("Claim expense relationship mismatch", claims.where(c("first_expense") < c("reported_date")), ["claim_id"]),
    ]


def gold_tables(state: GoldState, start: str, end: str) -> dict[str, DataFrame]:
    """The four Gold tables of a state, as ``gold.build_gold`` gives them for the whole history."""
    snapshot = gold.reconciled(state.claims.where("source_version IS NOT NULL"))
    direct = state.expenses.select("policy_id", "expense_scope", "amount", date_lit(end).alias("expense_date"))
    policy = gold.policy_performance(state.policies, snapshot, direct, start, end)
    summary = state.expenses.groupBy("expense_scope", "expense_category", "region", "currency").agg(
        F.sum("transaction_count").alias("transaction_count"), money(F.sum("amount")).alias("expense_amount"))
    return {"claim_snapshot": snapshot, "policy_performance": policy, "expense_summary": summary,
            "portfolio_performance": gold.portfolio_performance(policy, summary)}
