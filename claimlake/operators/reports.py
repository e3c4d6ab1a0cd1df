"""Report queries over ONE published valuation snapshot.

Gold tables are cumulative: summing two as_of dates double-counts, so each
report takes the frame of a single snapshot (see ``plans.publish.read_gold``,
which resolves the as_of_date through the publication manifest).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged


def report_portfolio(portfolio: DataFrame) -> DataFrame:
    return portfolio


def report_region_contribution(policy: DataFrame) -> DataFrame:
    return (
        policy.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("policy_count"),
            F.sum("earned_premium").alias("earned_premium"),
            F.sum("reported_incurred_amount").alias("reported_incurred"),
            F.sum("direct_expense").alias("direct_expense"),
            F.sum("reported_contribution_before_ibnr").alias("contribution_before_ibnr"),
        )
        .orderBy(F.col("earned_premium").desc())
    )


def report_expense_mix(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy("expense_scope", "expense_category")
        .agg(F.sum("expense_amount").alias("expense_amount"))
        .orderBy(F.col("expense_scope").asc(), F.col("expense_amount").desc())
    )


def report_unreconciled_claims(snapshot: DataFrame) -> DataFrame:
    return (
        snapshot.filter(~F.col("paid_reconciled"))
        .select("claim_id", "policy_id", "incurred_amount", "paid_amount", "ledger_paid_amount",
                "paid_reconciliation_difference", "paid_reconciled")
        .orderBy(F.abs(F.col("paid_reconciliation_difference")).desc())
    )


def positioned(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` in global order with ``position`` from 1, for readers that do not keep row order (O1-O3).

    The rows are sorted by range partitions and written once; a partition's rows are numbered as they
    lie, and the counts of the partitions before it (one small row per partition) give the rest.  No
    window gathers the table in one task.  ``order`` must tell all rows apart, or ties stay open."""
    row = F.monotonically_increasing_id()  # partition in the upper 31 bits, place within it in the lower 33
    held = staged(df.orderBy(*order).withColumn("_row", row), "positioned")
    part = F.shiftright("_row", 33)
    sizes = [(r["part"], r["n"]) for r in held.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()]
    before, starts = 0, []
    for number, n in sizes:
        starts.append((number, before))
        before += n
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _before long")
    return held.withColumn("_part", part).join(offsets, "_part").select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("position"))
