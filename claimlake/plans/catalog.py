"""Named queries over the benchmark tables, one per operator family.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame whose columns
are aliased to match the SQL oracle.  Audit timestamps (processing time) are
dropped here because they differ by construction between runs and engines.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, ibnr, policy_history, policy_silver, reports, silver
from ..schemas import (
    EXPENSES, EXPOSURE_FEED_FIELDS, GOLD_CLAIM_FIELDS, GOLD_EXPOSURE_FIELDS, IBNR_CLAIM_FIELDS, PAYMENT_FIELDS, PAYMENT_V2_FIELDS, PAYMENTS, POLICY_CHANGE_FIELDS, payments_v2,
)
from ..session import ensure_checkpoint_dir, staged, staged_by
from ..sources import arrivals, bronze_files
from ..sources import bronze as bronze_source
from ..sources import bronze_fixtures as bronze
from ..sources import defects
from ..sources import fixtures as fx
from ..sources import history
from . import day_commit, incremental, publish

START, END = fx.WINDOW_START, fx.WINDOW_END

Query = Callable[[SparkSession, str], DataFrame]


def _inputs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return fx.gold_inputs(fx.tables(spark, root))


def _by_claim(t: fx.Tables, claims: DataFrame) -> DataFrame:
    """Claims written once in buckets of their ids: what reads them often starts from there."""
    return staged_by(claims, "claims", "claim_id", t.parts("lineitem"))


def _by_policy(t: fx.Tables, exposure: DataFrame) -> DataFrame:
    """Exposure written once in buckets of its policies, for queries that read it several times."""
    return staged_by(exposure, "exposure", "policy_id", t.parts("orders"))


def _built(inputs: dict[str, DataFrame], end: str = END) -> dict[str, DataFrame]:
    # Checks are their own query (gold_violations); skip the extra action here.
    return gold.build_gold(inputs, START, end, check=False, processed_at=False)


def _gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return _built(_inputs(spark, root))


def claim_snapshot(spark, root):
    return _gold(spark, root)["claim_snapshot"]


def policy_performance(spark, root):
    return _gold(spark, root)["policy_performance"]


def expense_summary(spark, root):
    return _gold(spark, root)["expense_summary"]


def portfolio_performance(spark, root):
    """The one-row portfolio table; ratios keep Spark's decimal types."""
    return _gold(spark, root)["portfolio_performance"]


def claims_latest(spark, root):
    """Latest version of every claim (W2) after exact-duplicate collapse (A1)."""
    t = fx.tables(spark, root)
    return gold.latest_versions(gold.distinct_records(fx.claims(t), GOLD_CLAIM_FIELDS))


def claim_version_conflicts(spark, root):
    """G1 on the raw claim feed, where line numbers repeat within an order."""
    t = fx.tables(spark, root)
    unique = gold.distinct_records(fx.claim_events(t), GOLD_CLAIM_FIELDS)
    return gold.key_conflicts(unique, ["claim_id", "source_version"])


def gold_violations(spark, root):
    """All Gold checks on inputs whose claim feed still holds repeated versions."""
    t = fx.tables(spark, root)
    inputs = dict(_inputs(spark, root), claims_events=fx.claim_events(t))
    return gold.violations(inputs, START, END)


def gold_checks_fired(spark, root):
    """Every Gold check (G1-G10, each leg) on feeds that hold its defect."""
    t = fx.tables(spark, root)
    inputs = defects.gold_inputs(t, _by_claim(t, fx.claims(t)))
    inputs["daily_exposure"] = _by_policy(t, inputs["daily_exposure"].select(*GOLD_EXPOSURE_FIELDS))
    return gold.violations(inputs, START, END)


def ibnr_checks_fired(spark, root):
    """Every reserve check on feeds that hold its defect."""
    t = fx.tables(spark, root)
    exposure = _by_policy(t, defects.exposure(t).select("policy_id", "load_date", "earned_premium"))
    claims = _by_claim(t, defects.claims(t).select(*IBNR_CLAIM_FIELDS))
    return ibnr.violations(exposure, claims, BF_START, BF_END)


def report_portfolio(spark, root):
    return portfolio_performance(spark, root)


def report_region(spark, root):
    return reports.report_region_contribution(_gold(spark, root)["policy_performance"])


def report_expense_mix(spark, root):
    return reports.report_expense_mix(_gold(spark, root)["expense_summary"])


def report_unreconciled(spark, root):
    return reports.report_unreconciled_claims(_gold(spark, root)["claim_snapshot"])


def report_region_order(spark, root):
    """O1: regions by premium, with their place in the report."""
    return reports.positioned(report_region(spark, root), F.desc("earned_premium"), "region")


def report_expense_mix_order(spark, root):
    """O2: expenses by scope, then falling amount, with their place."""
    return reports.positioned(report_expense_mix(spark, root), "expense_scope", F.desc("expense_amount"), "expense_category")


def report_unreconciled_order(spark, root):
    """O3: unreconciled claims by the size of the difference, with their place."""
    return reports.positioned(report_unreconciled(spark, root), F.desc(F.abs("paid_reconciliation_difference")), "claim_id")


def header_contract(spark, root):
    """Which contract the header of each file of a written Bronze tree gives."""
    place = bronze_files.payment_headers(fx.tables(spark, root))
    found = bronze_source.header_contract(spark, place, {"v1": PAYMENT_FIELDS, "v2": PAYMENT_V2_FIELDS})
    return found.select(F.regexp_extract("source_file", "/year=([0-9]+)/", 1).cast("int").alias("year"), "contract")


def csv_load(spark, root):
    """A written Bronze tree read by the CSV source, malformed rows marked, files traced."""
    rows = bronze_source.read_whole_csv(spark, bronze_files.exposure_files(fx.tables(spark, root)), EXPOSURE_FEED_FIELDS)
    return rows.select(*EXPOSURE_FEED_FIELDS, F.col(bronze_source.MALFORMED).isNotNull().alias("is_malformed"),
                       F.regexp_extract("source_file", "/year=([0-9]+)/", 1).cast("int").alias("year"))


def publish_roundtrip(spark, root):
    """Policy rows of two runs published for one date; the reader gets the newer run, although
    the older one commits last."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/gold-{uuid.uuid4().hex}"
    older, newer = (publish.claim_generation(spark, folder, END) for _ in range(2))
    rows = staged(policy_performance(spark, root), "policy-rows")  # both runs publish them
    publish.check_contract(spark, folder, "policy_performance", rows)
    for generation, run, df in ((newer, "newer", rows), (older, "older", rows.where("reported_claim_count = 0"))):
        place = publish.write_generation(df, folder, "policy_performance", END, run)
        publish.write_manifest(spark, folder, START, END, run, {}, {"policy_performance": place}, generation)
    return publish.read_gold(spark, folder, "policy_performance", END)


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop("silver_processed_at")


def claims_dq_split(spark, root):
    """Typed claim events with every failed rule listed (C1 rules, P1-P8)."""
    return _no_audit(silver.checked_claims(bronze.claims_feed(fx.tables(spark, root))))


def claims_silver(spark, root):
    """Valid claim events, one per (load_date, event_id)."""
    return _no_audit(silver.silver_claims(bronze.claims_feed(fx.tables(spark, root))).valid)


def exposure_dq_split(spark, root):
    """Exposure rules incl. duplicate id / policy-day counts."""
    checked = silver.checked_exposure(bronze.exposure_feed(fx.tables(spark, root)))
    return checked.select(*[c for c in silver.EXPOSURE_SILVER_COLUMNS if c != "silver_processed_at"],
                          "dq_errors", "load_date")


def _ledger(spark, root, kind):
    t = fx.tables(spark, root)
    if kind == "payments":
        return silver.silver_ledger(bronze.payments_feed(t), PAYMENTS)
    return silver.silver_ledger(bronze.expenses_feed(t), EXPENSES)


def payments_dq(spark, root):
    """Payment quarantine: malformed lines, rule failures, conflicting ids."""
    return _no_audit(_ledger(spark, root, "payments").quarantine)


def payments_silver(spark, root):
    return _no_audit(_ledger(spark, root, "payments").valid)


def payments_load_metrics(spark, root):
    """input = valid + quarantine + duplicates collapsed, per load date (K8)."""
    return _ledger(spark, root, "payments").metrics


def expenses_dq_scope(spark, root):
    """Expense quarantine incl. category/scope allocation rules (C4)."""
    return _no_audit(_ledger(spark, root, "expenses").quarantine)


def expenses_silver(spark, root):
    return _no_audit(_ledger(spark, root, "expenses").valid)


def load_metrics(spark, root):
    """input = valid + quarantine + duplicates collapsed for all four feeds, measured by the writes of
    their commits (K8, A15); each whole feed is one load.  What several writes read is derived once."""
    t = fx.tables(spark, root)
    latest = staged(fx.latest_claims(t), "latest-claims")
    payments, expenses = fx.payments_of(latest), fx.expenses_of(t, latest.select("claim_id", "policy_id"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/load-metrics-{uuid.uuid4().hex}"
    loads = {"claims_events": lambda: silver.silver_claims(staged(bronze.claims_feed(t), "claims-feed")),
             "daily_exposure": lambda: silver.silver_exposure(staged(bronze.exposure_feed(t), "exposure-feed")),
             "claim_payments": lambda: silver.silver_ledger(bronze.payments_feed(t, payments), PAYMENTS),
             "expense_transactions": lambda: silver.silver_ledger(bronze.expenses_feed(t, expenses), EXPENSES)}
    for dataset, load in loads.items():
        day_commit.publish_day(spark, folder, dataset, END, load)
    return reduce(DataFrame.unionByName, [day_commit.load_metrics(spark, folder, dataset, END, END) for dataset in loads]).drop("load_date")


def claims_quarantine(spark, root):
    """Claim events that fail a rule."""
    return _no_audit(silver.silver_claims(bronze.claims_feed(fx.tables(spark, root))).quarantine)


def exposure_quarantine(spark, root):
    """Exposure rows that fail a rule."""
    return _no_audit(silver.silver_exposure(bronze.exposure_feed(fx.tables(spark, root))).quarantine)


def exposure_silver(spark, root):
    """Valid exposure rows."""
    return _no_audit(silver.silver_exposure(bronze.exposure_feed(fx.tables(spark, root))).valid)


# Bornhuetter-Ferguson run on the derived history.  The ELR and the
# pattern are illustrative model parameters (the method supplies none);
# proportions carry two decimals so the decimal products are exact.
BF_START, BF_END = "1995-01-01", "2001-11-15"
BF_ELR = "0.65"
BF_PATTERN_JSON = (
    '{"0": 0.10, "1": 0.25, "2": 0.40, "3": 0.50, "4": 0.60, "5": 0.70, "6": 0.78, '
    '"7": 0.85, "8": 0.90, "9": 0.94, "10": 0.97, "11": 0.99, "12": 1.00}'
)


def _bf_inputs(spark, root):
    t = fx.tables(spark, root)
    return fx.exposure(t), fx.claims(t)


def ibnr_premium_month(spark, root):
    """Earned premium per accident month."""
    exposure, claims = _bf_inputs(spark, root)
    return ibnr.premium_by_month(ibnr.prepare(exposure, claims).exposure)


def ibnr_loss_month(spark, root):
    """Latest reported incurred per accident month."""
    exposure, claims = _bf_inputs(spark, root)
    return ibnr.losses_by_month(ibnr.prepare(exposure, claims).latest, BF_START, BF_END)


def _bf(spark, root, start=BF_START, end=BF_END):
    exposure, claims = _bf_inputs(spark, root)
    a = ibnr.parse_assumptions(BF_ELR, BF_PATTERN_JSON)
    return ibnr.ibnr_bf(exposure, claims, a, ibnr.pattern_frame(spark, a), start, end,
                        check=False, processed_at=False)


def ibnr_bf(spark, root):
    """BF IBNR by accident month (C11: P18-P22, J7, J8)."""
    return _bf(spark, root)


def ibnr_portfolio(spark, root):
    """Portfolio IBNR = sum over accident months of one valuation."""
    return ibnr.portfolio_ibnr(_bf(spark, root))


def ibnr_violations(spark, root):
    """BF input checks on a claim feed that still repeats versions."""
    t = fx.tables(spark, root)
    return ibnr.violations(fx.exposure(t), fx.claim_events(t), BF_START, BF_END)


def _in_window(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """The Silver history read for [start, end] (partition pruning on the
    business date the fixtures use as load date)."""
    return df.filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def ibnr_adjusted_result(spark, root):
    """reported_result_before_ibnr - portfolio IBNR over the whole history (D7): all four
    inputs, the exposure and claims of the reserve among them, for the same window."""
    portfolio = _gold(spark, root)["portfolio_performance"]
    return ibnr.adjusted_result(portfolio, _bf(spark, root, START, END))


LONG_TAIL_JSON = json.dumps({str(age): (10 + 90 * age // 480) / 100 for age in range(481)})


def _long_tail(spark, root):
    exposure, claims = _bf_inputs(spark, root)
    a = ibnr.parse_assumptions(BF_ELR, LONG_TAIL_JSON)
    return ibnr.ibnr_bf(exposure, claims, a, ibnr.pattern_frame(spark, a), START, END, check=False, processed_at=False)


def ibnr_long_tail(spark, root):
    """Reserve by accident month under a development of forty years, so that every month is still open."""
    return _long_tail(spark, root).drop("reporting_pattern_json")


def ibnr_adjusted_long_tail(spark, root):
    """D7 with a reserve above zero and the expenses of the window: result before IBNR less the reserve."""
    return ibnr.adjusted_result(_gold(spark, root)["portfolio_performance"], _long_tail(spark, root))


def _policy_scd2(t):
    return policy_history.scd2(fx.policy_versions(t))


def scd2_history(spark, root):
    """Effective-dated policy versions with [valid_from, valid_to)."""
    return _policy_scd2(fx.tables(spark, root))


def policy_as_of(spark, root):
    """Each exposure day with the policy version effective that day (D3)."""
    t = fx.tables(spark, root)
    facts = fx.exposure(t).select("exposure_record_id", "policy_id", "load_date", "earned_premium")
    return policy_history.as_of_join(facts, _policy_scd2(t), "policy_id", "load_date",
                                     ["coverage_type", "annual_premium", "version_number"])


def policy_change_checks(spark, root):
    """Policy-change feed validation: policy exists, version increases,
    effective date not before the update's business date (D1)."""
    t = fx.tables(spark, root)
    return policy_history.change_violations(fx.policy_changes(t), fx.policies(t))


def scd2_gaps(spark, root):
    """Overlaps and gaps between versions of one policy."""
    return policy_history.interval_violations(_policy_scd2(fx.tables(spark, root)))


def interval_integrity(spark, root):
    """Overlaps, nested ones among them, and gaps between cover periods of one policy."""
    return policy_history.interval_violations(fx.policy_terms(fx.tables(spark, root)))


def _policy_silver(spark, root):
    t = fx.tables(spark, root)
    return policy_silver.silver_policy_changes(fx.policy_change_feed(t), fx.policies(t))


def policy_changes_dq(spark, root):
    """Policy-change quarantine with every failed rule."""
    return _no_audit(_policy_silver(spark, root).quarantine)


def policy_changes_silver(spark, root):
    """Valid policy changes, typed, re-sent rows collapsed."""
    return _no_audit(_policy_silver(spark, root).valid)


def scd2_merge(spark, root):
    """Policy history built year by year: each delivery is spliced into the chains of its policies.
    Deliveries and history lie in buckets of their policies, so a splice moves changed chains only."""
    parts = fx.tables(spark, root).parts("orders")
    valid = staged_by(_policy_silver(spark, root).valid.select(*POLICY_CHANGE_FIELDS, "load_date"), "policy-changes", "policy_id", parts)
    years = [r[0] for r in valid.select("load_date").distinct().orderBy("load_date").collect()]  # one row per delivery
    day = lambda d: valid.where(F.col("load_date") == F.lit(d)).drop("load_date")
    history = policy_history.scd2(day(years[0]) if years else valid.drop("load_date"))
    for d in years[1:]:
        history = policy_history.splice(staged_by(history, "policy-history", "policy_id", parts), day(d), parts=parts)
    return history


SNAPSHOT_EARLIER_END = "2001-12-31"


def snapshot_diff(spark, root):
    """Policy performance valued at two dates, row differences."""
    t = fx.tables(spark, root)
    inputs = fx.gold_inputs(t, _by_claim(t, fx.claims(t)))
    inputs["daily_exposure"] = _by_policy(t, inputs["daily_exposure"])
    later = _built(inputs)["policy_performance"]
    inputs["claim_payments"] = _in_window(inputs["claim_payments"], "payment_date", START, SNAPSHOT_EARLIER_END)
    inputs["expense_transactions"] = _in_window(
        inputs["expense_transactions"], "expense_date", START, SNAPSHOT_EARLIER_END)
    earlier = _built(inputs, SNAPSHOT_EARLIER_END)["policy_performance"]
    drop = ["period_start", "period_end"]
    return policy_history.snapshot_diff(earlier.drop(*drop), later.drop(*drop))


CELL_DATES = ["1999-12-31", END]


def _two_snapshots(spark, root, table: str) -> list[DataFrame]:
    """One Gold table built from the rows that had arrived by each of two dates."""
    feeds = arrivals.feeds(fx.tables(spark, root))
    built = []
    for end in CELL_DATES:
        inputs = {name: df.where(F.col("arrival") <= F.lit(end).cast("date")).drop("arrival") for name, df in feeds.items()}
        built.append(gold.build_gold(inputs, START, end, check=False, processed_at=False)[table].drop("period_start", "period_end"))
    return built


def snapshot_cells(spark, root):
    """Policy performance valued at two dates, differences cell by cell (D5): exposure, claims,
    payments and expenses all move between them.  Ratios are left to the cells they follow from."""
    before, after = (df.drop(*[c for c, t in df.dtypes if t == "double"]) for df in _two_snapshots(spark, root, "policy_performance"))
    return policy_history.snapshot_cells(before, after, "policy_id")


def generation_digest(spark, root):
    """Order-free digests of the claim snapshot of two dates, and of the first one built again."""
    first, last = _two_snapshots(spark, root, "claim_snapshot")
    dated = [(CELL_DATES[0], first), (CELL_DATES[1], last), (CELL_DATES[0], first.orderBy("paid_amount").repartition(3))]
    keep = ["claim_id", "policy_id", "source_version", "incident_date", "incurred_amount", "ledger_paid_amount", "paid_reconciled"]
    return reduce(DataFrame.unionByName, [policy_history.generation_digest(df.select(keep)).select(
        F.lit(number).alias("build"), F.lit(day).alias("valuation_date"), "rows", "digest") for number, (day, df) in enumerate(dated)])


def _policy_sums(spark, root):
    """The one aggregation that policy_performance projects."""
    r = gold.resolve(_inputs(spark, root))
    return gold.policy_sums(r.exposure, gold.claim_snapshot(r.latest, r.payments), r.expenses, START, END)


def _part_of_sums(sums: DataFrame, present: str, **columns: str) -> DataFrame:
    """The policies with rows of one kind, and the sums of that kind."""
    return sums.where(present).select("policy_id", *[F.col(old).alias(new) for new, old in columns.items()])


def policy_premiums(spark, root):
    """A5: premium and exposure per policy."""
    return _part_of_sums(_policy_sums(spark, root), "_exposure_rows > 0", earned_premium="_premium", earned_exposure="_exposure")


def policy_losses(spark, root):
    """In-window reported losses per policy."""
    return _part_of_sums(
        _policy_sums(spark, root), "_claims > 0", reported_claim_count="_claims", reported_incurred="_incurred", source_paid="_paid",
        ledger_paid="_ledger", unreconciled_claim_count="_unreconciled", negative_reserve_claim_count="_negative")


def policy_costs(spark, root):
    """Direct claim/policy expenses per policy."""
    return _part_of_sums(_policy_sums(spark, root), "_claim_expense IS NOT NULL",
                         claim_expense="_claim_expense", policy_expense="_policy_expense")


def policy_attributes(spark, root):
    """Latest rating attributes per policy."""
    return _part_of_sums(_policy_sums(spark, root), "_exposure_rows > 0", region="attrs.region",
                         customer_segment="attrs.customer_segment", age_band="attrs.age_band", as_of_load_date="attrs_day")


def policy_spine(spark, root):
    """The policy ids reported on."""
    return _policy_sums(spark, root).select("policy_id")


def overhead(spark, root):
    """A10: portfolio and corporate overhead, as the portfolio row carries it."""
    return portfolio_performance(spark, root).select("portfolio_expense", "corporate_expense")


VALUATIONS = ["1998-06-30", "2001-12-31", "2024-01-10", END]


def _valued(spark, root, table: str) -> DataFrame:
    built = incremental.valuations(arrivals.deltas(fx.tables(spark, root), VALUATIONS), START)
    return reduce(DataFrame.unionByName, [tables[table].withColumn("valuation_date", F.lit(end).cast("date")) for end, tables in built])


def backfill_incremental(spark, root):
    """Portfolio rows of four valuation dates, each merged from the state of the date before (C17)."""
    return _valued(spark, root, "portfolio_performance")


def backfill_incremental_policies(spark, root):
    """Policy rows of four valuation dates, each merged from the state of the date before (C17)."""
    return _valued(spark, root, "policy_performance")


PAYMENT_V2_CUTOVER = "1999-01-01"
PAYMENT_METHODS = ("EFT", "CHEQUE")


def payments_v2_union(spark, root):
    """Schema evolution (D6): v1 and v2 files loaded with their own contract;
    v1 rows read back with payment_method NULL."""
    latest = staged(fx.latest_claims(fx.tables(spark, root)), "latest-claims")  # both loads start from it
    v1_lines, v2_lines = bronze.payments_feed_versions(fx.payments_of(latest), PAYMENT_V2_CUTOVER)
    v1 = silver.silver_ledger(v1_lines, PAYMENTS).valid
    v2 = silver.silver_ledger(v2_lines, payments_v2(PAYMENT_METHODS)).valid
    return _no_audit(v1.unionByName(v2, allowMissingColumns=True))


EXPOSURE_HISTORY_START, EXPOSURE_HISTORY_END = "1995-01-01", "2001-08-01"


def exposure_missing_days(spark, root):
    """Days of the exposure history with no exposure row at all."""
    t = fx.tables(spark, root)
    return history.days_without_rows(spark, fx.exposure_all(t), "load_date",
                                     EXPOSURE_HISTORY_START, EXPOSURE_HISTORY_END)


QUERIES: dict[str, Query] = {
    "header_contract": header_contract,
    "csv_load": csv_load,
    "publish_roundtrip": publish_roundtrip,
    "snapshot_cells": snapshot_cells,
    "generation_digest": generation_digest,
    "report_region_order": report_region_order,
    "report_expense_mix_order": report_expense_mix_order,
    "report_unreconciled_order": report_unreconciled_order,
    "ibnr_long_tail": ibnr_long_tail,
    "ibnr_adjusted_long_tail": ibnr_adjusted_long_tail,
    "backfill_incremental": backfill_incremental,
    "backfill_incremental_policies": backfill_incremental_policies,
    "exposure_missing_days": exposure_missing_days,
    "payments_v2_union": payments_v2_union,
    "policy_premiums": policy_premiums,
    "policy_losses": policy_losses,
    "policy_costs": policy_costs,
    "policy_attributes": policy_attributes,
    "policy_spine": policy_spine,
    "overhead": overhead,
    "scd2_history": scd2_history,
    "policy_as_of": policy_as_of,
    "policy_change_checks": policy_change_checks,
    "scd2_gaps": scd2_gaps,
    "interval_integrity": interval_integrity,
    "policy_changes_dq": policy_changes_dq,
    "policy_changes_silver": policy_changes_silver,
    "scd2_merge": scd2_merge,
    "snapshot_diff": snapshot_diff,
    "ibnr_premium_month": ibnr_premium_month,
    "ibnr_loss_month": ibnr_loss_month,
    "ibnr_bf": ibnr_bf,
    "ibnr_portfolio": ibnr_portfolio,
    "ibnr_violations": ibnr_violations,
    "ibnr_adjusted_result": ibnr_adjusted_result,
    "claims_dq_split": claims_dq_split,
    "claims_silver": claims_silver,
    "exposure_dq_split": exposure_dq_split,
    "payments_dq": payments_dq,
    "payments_silver": payments_silver,
    "payments_load_metrics": payments_load_metrics,
    "load_metrics": load_metrics,
    "claims_quarantine": claims_quarantine,
    "exposure_quarantine": exposure_quarantine,
    "exposure_silver": exposure_silver,
    "expenses_dq_scope": expenses_dq_scope,
    "expenses_silver": expenses_silver,
    "claim_snapshot": claim_snapshot,
    "policy_performance": policy_performance,
    "expense_summary": expense_summary,
    "portfolio_performance": portfolio_performance,
    "claims_latest": claims_latest,
    "claim_version_conflicts": claim_version_conflicts,
    "gold_violations": gold_violations,
    "gold_checks_fired": gold_checks_fired,
    "ibnr_checks_fired": ibnr_checks_fired,
    "report_portfolio": report_portfolio,
    "report_region": report_region,
    "report_expense_mix": report_expense_mix,
    "report_unreconciled": report_unreconciled,
}
