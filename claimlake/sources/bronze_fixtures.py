"""Bronze feed text derived from the benchmark tables, with injected defects.

The Silver loads are exercised on the text a source system would send:
every fixture row is rendered as strings (claims/exposure) or as one CSV
line (ledgers), and a deterministic rule on the row's numeric keys corrupts
particular fields so every quarantine rule fires somewhere.  Rows are only
ever altered or added (duplicates, conflicts, malformed lines) -- never
filtered out -- so the load works over the whole tables.

The file date (``load_date``) of a row is its business date: the order
date for claims and exposure, the transaction date for the ledgers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.plan import evaluated_once
from ..schemas import CLAIM_EVENT_FIELDS, EXPENSE_FIELDS, EXPOSURE_FEED_FIELDS, PAYMENT_FIELDS, PAYMENT_V2_FIELDS
from . import fixtures as fx


def _every(key: Column, n: int) -> Column:
    return F.pmod(key, F.lit(n)) == 0


def _d(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _file(prefix: str, dataset: str, day: Column) -> Column:
    return F.concat(F.lit(f"bronze/{prefix}/{dataset}_"), _d(day), F.lit(".csv"))


def claims_feed(t: fx.Tables) -> DataFrame:
    """claim events as 16 text columns + source_file + load_date."""
    ev = fx.claim_events(t)
    k, s = F.col("l_partkey"), F.col("l_suppkey")
    ship, order_day = F.col("l_shipdate"), F.col("o_orderdate").cast("date")
    stamp = F.date_format(ship, "yyyy-MM-dd'T'HH:mm:ss")
    cols = {
        "event_id": F.when(_every(k, 17), F.lit("")).otherwise(F.col("event_id")),
        "claim_id": F.col("claim_id"),
        "policy_id": F.when(_every(s, 19), F.lit(" ")).otherwise(F.col("policy_id")),
        "operation": F.when(_every(k, 23), F.lit("merge"))
        .when(F.col("l_linenumber") == 1, F.lit(" insert")).otherwise(F.lit("update")),
        "source_version": F.when(_every(k, 29), F.lit("1.5")).otherwise(F.col("l_linenumber").cast("string")),
        "source_updated_at": F.when(_every(k, 31), stamp).otherwise(F.concat(stamp, F.lit("+00:00"))),
        "incident_date": F.when(_every(k, 37), F.lit("2026-13-01")).otherwise(_d(order_day)),
        "reported_date": F.when(_every(k, 41), _d(F.date_sub(order_day, 1))).otherwise(_d(order_day)),
        "arrival_timestamp": F.when(_every(s, 43), F.lit("yesterday"))
        .otherwise(F.concat(_d(order_day), F.lit("T06:30:00-05:00"))),
        "incident_type": F.when(F.col("l_returnflag") == "R", F.lit("Collision"))
        .when(F.col("l_returnflag") == "A", F.lit("Glass"))
        .when(_every(k, 47), F.lit("")).otherwise(F.lit("Theft")),
        "claim_status": F.when(F.col("l_linestatus") == "F", F.lit("closed")).otherwise(F.lit(" OPEN ")),
        "incurred_amount": F.when(_every(k, 53), F.lit("-1")).otherwise(F.col("incurred_amount").cast("string")),
        "paid_amount": F.when(_every(s, 59), F.lit("abc")).otherwise(F.col("paid_amount").cast("string")),
        "police_reported": F.when(_every(k, 61), F.lit("MAYBE"))
        .when(F.pmod(s, F.lit(3)) == 0, F.lit("y")).when(F.pmod(s, F.lit(3)) == 1, F.lit("N"))
        .otherwise(F.lit("unknown")),
        "fraud_score": F.when(_every(k, 67), F.lit("101")).otherwise(F.pmod(k, F.lit(101)).cast("string")),
        "manual_review_required": F.when(_every(k, 71), F.lit("perhaps"))
        .when(F.pmod(s, F.lit(4)) == 0, F.lit("TRUE")).when(F.pmod(s, F.lit(4)) == 1, F.lit("n"))
        .when(F.pmod(s, F.lit(4)) == 2, F.lit("1")).otherwise(F.lit("false")),
    }
    return ev.select(*[cols[f].alias(f) for f in CLAIM_EVENT_FIELDS],
                     _file("claims-events", "claim_events", order_day).alias("source_file"),
                     order_day.alias("load_date"))


def exposure_feed(t: fx.Tables) -> DataFrame:
    """daily exposure as 8 text columns + source_file + load_date."""
    ex = fx.exposure_all(t)
    o = F.col("o_orderkey")
    day = F.col("load_date")
    cols = {
        "exposure_record_id": F.when(_every(o, 97), F.concat(F.lit("EXR-DUP-"), _d(day)))
        .otherwise(F.col("exposure_record_id")),
        "policy_id": F.when(_every(o, 89), F.lit("")).otherwise(F.col("policy_id")),
        "region": F.when(_every(o, 83), F.lit("Unknown_Region")).otherwise(F.col("region")),
        "customer_segment": F.when(_every(o, 79), F.lit("  ")).otherwise(F.col("customer_segment")),
        "age_band": F.col("age_band"),
        "earned_exposure": F.when(_every(o, 73), F.lit("1.5")).when(_every(o, 71), F.lit("n/a"))
        .otherwise(F.col("earned_exposure").cast("string")),
        "earned_premium": F.when(_every(o, 67), F.lit("-5")).otherwise(F.col("earned_premium").cast("string")),
        "annual_premium": F.when(_every(o, 61), F.lit("")).otherwise(F.col("annual_premium").cast("string")),
    }
    return ex.select(*[cols[f].alias(f) for f in EXPOSURE_FEED_FIELDS],
                     _file("daily-exposure", "daily_exposure", day).alias("source_file"),
                     day.alias("load_date"))


def _line(cols: list[Column]) -> Column:
    return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cols])


def _ledger_lines(base: DataFrame, fields: list[str], key: Column, day_col: str,
                  prefix: str, dataset: str, amount_conflict: Column) -> DataFrame:
    """Render rows as CSV lines, then add exact re-sends (collapse), conflicting
    re-sends (quarantine) and malformed variants of some lines."""
    text = {f: F.col(f) for f in fields}
    rendered = base.select(
        key.alias("_k"), F.col(day_col).alias("load_date"),
        *[text[f].alias(f) for f in fields],
    )
    plain = _line([F.col(f) for f in fields])
    # Quoted source_system is the same value once parsed.
    quoted = _line([F.concat(F.lit('"'), F.col(f), F.lit('"')) if f == "source_system" else F.col(f)
                    for f in fields])
    k = F.col("_k")
    line = (
        F.when(_every(k, 13), F.concat(plain, F.lit(",EXTRA")))
        .when(_every(k, 19), F.concat(F.lit('"'), plain))
        .when(_every(k, 7), quoted)
        .otherwise(plain)
    )
    day = F.col("load_date")
    originals = rendered.select(line.alias("value"), day.alias("load_date"), k)
    # Re-sent with a trailing zero on the amount: equal after normalisation.
    resent = rendered.filter(_every(k, 5)).select(
        _line([F.concat(F.col(f), F.lit("0")) if f == "amount" else F.col(f) for f in fields]).alias("value"),
        day.alias("load_date"), k)
    conflicting = rendered.filter(_every(k, 11)).select(
        _line([amount_conflict if f == "amount" else F.col(f) for f in fields]).alias("value"),
        day.alias("load_date"), k)
    lines = originals.unionByName(resent).unionByName(conflicting)
    # a line is rendered once: what reads it must not render it again per use, as a file scan would not
    return evaluated_once(lines.select("value", _file(prefix, dataset, F.col("load_date")).alias("source_file"), "load_date"))


def _amount_plus_one() -> Column:
    return (F.col("amount").try_cast("decimal(18,2)") + F.lit(1)).cast("decimal(18,2)").cast("string")


def _payment_text(p: DataFrame) -> DataFrame:
    k = F.substring(F.col("claim_id"), 5, 20).cast("bigint")
    day = F.col("payment_date")
    created = F.concat(_d(day), F.lit("T06:00:00Z"))
    text = p.select(
        k.alias("_key"),
        day.alias("_day"),
        F.col("payment_id"),
        F.when(_every(k, 53), F.concat(F.lit("CLAIM-"), k.cast("string"))).otherwise(F.col("claim_id")).alias("claim_id"),
        F.col("policy_id"),
        F.when(_every(k, 29), _d(F.date_add(day, 1))).otherwise(_d(day)).alias("payment_date"),
        F.lit("indemnity").alias("payment_type"),
        F.when(_every(k, 43), F.lit("LAWYER")).otherwise(F.col("payee_type")).alias("payee_type"),
        F.when(_every(k, 23), F.lit("1.005")).otherwise(F.col("amount").cast("string")).alias("amount"),
        F.when(_every(k, 17), F.lit("CA")).otherwise(F.lit("cad")).alias("currency"),
        F.col("source_event_id"),
        F.when(_every(k, 47), F.lit("0")).otherwise(F.col("source_version").cast("string")).alias("source_version"),
        F.col("source_system"),
        F.when(_every(k, 31), F.concat(_d(day), F.lit("T06:00:00")))
        .when(_every(k, 41), F.concat(_d(F.date_sub(day, 1)), F.lit("T06:00:00Z")))
        .otherwise(created).alias("created_at"),
        F.when(_every(k, 37), F.concat(_d(day), F.lit("T05:00:00+00:00")))
        .otherwise(F.concat(_d(day), F.lit("T08:30:00.250000+02:00"))).alias("updated_at"),
    )
    k = F.col("_key")
    method = (F.when(_every(k, 61), F.lit("CASH")).when(F.pmod(k, F.lit(3)) == 0, F.lit("EFT"))
              .when(F.pmod(k, F.lit(3)) == 1, F.lit("cheque")))
    return text.withColumn("payment_method", method)


def payments_feed(t: fx.Tables, payments: DataFrame | None = None) -> DataFrame:
    """claim payment ledger as raw CSV lines (value, source_file, load_date), of ``payments`` if given."""
    return _ledger_lines(_payment_text(fx.payments(t) if payments is None else payments), PAYMENT_FIELDS, F.col("_key"), "_day", "claim-payments",
                         "claim_payments", _amount_plus_one())


def payments_feed_versions(payments: DataFrame, cutover: str) -> tuple[DataFrame, DataFrame]:
    """The same ledger where files dated on or after ``cutover`` use the v2
    layout (an extra nullable payment_method column): (v1 lines, v2 lines)."""
    text = _payment_text(payments)
    is_v2 = F.col("_day") >= F.lit(cutover).cast("date")
    v1 = _ledger_lines(text.filter(~is_v2), PAYMENT_FIELDS, F.col("_key"), "_day", "claim-payments",
                       "claim_payments", _amount_plus_one())
    v2 = _ledger_lines(text.filter(is_v2), PAYMENT_V2_FIELDS, F.col("_key"), "_day", "claim-payments",
                       "claim_payments", _amount_plus_one())
    return v1, v2


def expenses_feed(t: fx.Tables, expenses: DataFrame | None = None) -> DataFrame:
    """expense ledger as raw CSV lines (value, source_file, load_date), of ``expenses`` if given."""
    e = fx.expenses(t) if expenses is None else expenses
    k = F.substring(F.col("expense_id"), 5, 20).cast("bigint")
    day = F.col("expense_date")
    scope = F.col("expense_scope")
    text = e.select(
        k.alias("_key"),
        day.alias("_day"),
        F.col("expense_id"),
        _d(day).alias("expense_date"),
        F.when(_every(k, 29), F.lit("CLOUD_INFRASTRUCTURE")).when(_every(k, 31), F.lit("TRAVEL"))
        .otherwise(F.lower(F.col("expense_category"))).alias("expense_category"),
        F.when(_every(k, 37), F.lit("GLOBAL")).otherwise(scope).alias("expense_scope"),
        F.when(_every(k, 23), F.lit("12.345")).otherwise(F.col("amount").cast("string")).alias("amount"),
        F.lit("CAD").alias("currency"),
        F.when(_every(k, 41) & (scope == "POLICY"), F.lit("CLM-000000001")).otherwise(F.col("claim_id")).alias("claim_id"),
        F.when(_every(k, 43) & (scope == "CLAIM"), F.lit(None).cast("string")).otherwise(F.col("policy_id")).alias("policy_id"),
        F.when(_every(k, 47) & (scope == "CORPORATE"), F.lit("ASIA")).otherwise(F.col("region")).alias("region"),
        F.col("source_system"),
        F.concat(F.date_format(F.col("created_at"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("created_at"),
        F.concat(F.date_format(F.col("updated_at"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("updated_at"),
    )
    return _ledger_lines(text, EXPENSE_FIELDS, F.col("_key"), "_day", "expense-transactions",
                         "expense_transactions", _amount_plus_one())
