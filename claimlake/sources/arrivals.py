"""The insurance feeds by the day on which a row arrives, some rows again on a later day.

Claims arrive when both reported and updated, exposure and expenses on their own day, payments
up to three months after theirs.  Every eleventh claim version, payment and expense is sent a
second time, unchanged.  No row is dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from . import fixtures as fx

AGAIN = 11  # one key in so many is sent a second time


def _number(key: str) -> Column:
    return F.regexp_extract(key, "([0-9]+)", 1).cast("bigint")


def _resent(df: DataFrame, key: str, days: int) -> DataFrame:
    again = df.where(F.pmod(_number(key), F.lit(AGAIN)) == 0)
    return df.unionByName(again.withColumn("arrival", F.date_add("arrival", days)))


def feeds(t: fx.Tables) -> dict[str, DataFrame]:
    """The four Silver datasets with ``arrival``, each written once.  Payments and the claims that
    expenses attach to come from the written claims, not from the line items again."""
    arrived = fx.claims(t).withColumn("arrival", F.greatest("reported_date", F.to_date("source_updated_at")))
    claims = staged(_resent(arrived, "claim_id", 400), "arrivals-claims_events")
    latest = staged(fx.latest_of(claims), "latest-claims")
    payments = fx.payments_of(latest).withColumn("arrival", F.date_add("payment_date", F.pmod(_number("payment_id"), F.lit(90)).cast("int")))
    expenses = fx.expenses_of(t, latest.select("claim_id", "policy_id"))
    return {
        "claims_events": claims,
        "daily_exposure": staged(fx.exposure(t).withColumn("arrival", F.col("load_date")), "arrivals-daily_exposure"),
        "claim_payments": staged(_resent(payments, "payment_id", 400), "arrivals-claim_payments"),
        "expense_transactions": staged(_resent(expenses.withColumn("arrival", F.col("expense_date")), "expense_id", 3), "arrivals-expense_transactions"),
    }


def deltas(t: fx.Tables, ends: list[str]) -> list[tuple[str, dict[str, DataFrame]]]:
    """For each end, ascending, the rows that arrived since the end before it (the feeds are written once)."""
    every, out, before = feeds(t), [], None
    for end in ends:
        inside = [F.col("arrival") <= F.lit(end).cast("date")]
        if before:
            inside.append(F.col("arrival") > F.lit(before).cast("date"))
        out.append((end, {name: df.where(reduce(Column.__and__, inside)).drop("arrival") for name, df in every.items()}))
        before = end
    return out
