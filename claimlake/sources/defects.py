"""The insurance feeds with defects, so that every Gold and reserve check has rows to find.

Values are changed and twins are added by the number in a row's key; no row is dropped.
Each feed may be given as ``sound`` rows that were derived before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixtures as fx

EVERY = 40                  # one key in so many has a given defect
DRY_MONTH = "1996-03-01"    # a month whose exposure earns no premium
NOWHERE = "CLM-NONE"        # a claim that does not exist


def _part(key: str) -> Column:
    return F.pmod(F.regexp_extract(key, "([0-9]+)", 1).cast("bigint"), F.lit(EVERY))


def _changed(df: DataFrame, column: str, when: Column, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(when, value).otherwise(F.col(column)).cast(df.schema[column].dataType))


def _with_twins(df: DataFrame, when: Column, amount: str) -> DataFrame:
    """A second record of the same key, one unit dearer."""
    twins = df.where(when).withColumn(amount, (F.col(amount) + 1).cast(df.schema[amount].dataType))
    return df.unionByName(twins)


def claims(t: fx.Tables, sound: DataFrame | None = None) -> DataFrame:
    k, df = _part("claim_id"), fx.claims(t) if sound is None else sound
    df = _changed(df, "incurred_amount", k == 1, F.lit(-1))
    df = _changed(df, "policy_id", (k == 2) & (F.col("source_version") > 1), F.concat("policy_id", F.lit("-M")))
    df = _changed(df, "operation", k == 3, F.lit("DELETE"))
    return _with_twins(df, k == 4, "incurred_amount")


def exposure(t: fx.Tables, sound: DataFrame | None = None) -> DataFrame:
    k, df = _part("exposure_record_id"), fx.exposure(t) if sound is None else sound
    dry = F.trunc("load_date", "month") == F.lit(DRY_MONTH).cast("date")
    df = _changed(df, "earned_premium", dry | (k == 1), F.when(dry, 0).otherwise(-1))
    return _with_twins(df, (k == 2) & ~dry, "earned_premium")


def payments(t: fx.Tables, sound: DataFrame | None = None) -> DataFrame:
    k, df = _part("payment_id"), fx.payments(t) if sound is None else sound
    df = _changed(df, "currency", k == 5, F.lit("USD"))
    df = _changed(df, "payment_date", k == 6, F.lit("1990-01-01").cast("date"))
    return _with_twins(df, k == 7, "amount")


def expenses(t: fx.Tables, sound: DataFrame | None = None) -> DataFrame:
    k, df, scope = _part("expense_id"), fx.expenses(t) if sound is None else sound, F.col("expense_scope")
    df = _changed(df, "currency", k == 5, F.lit("USD"))
    df = _changed(df, "claim_id", ((k == 6) & scope.isin("PORTFOLIO", "CORPORATE")) | ((k == 8) & (scope == "CLAIM")), F.lit(NOWHERE))
    return _with_twins(df, k == 7, "amount")


def gold_inputs(t: fx.Tables, written: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four feeds of ``fx.gold_inputs``, with defects."""
    sound = fx.gold_inputs(t, written)
    return {"claims_events": claims(t, sound["claims_events"]), "daily_exposure": exposure(t, sound["daily_exposure"]),
            "claim_payments": payments(t, sound["claim_payments"]), "expense_transactions": expenses(t, sound["expense_transactions"])}
