"""Effective-dated policy history (SCD type 2) and point-in-time joins.

* ``change_violations``  validates a policy-change feed: the policy exists,
  versions increase in update order, and the effective date is not before
  the business date of the update.
* ``scd2``               turns ordered changes into [valid_from, valid_to)
  intervals (valid_to NULL = current).
* ``as_of_join``         attaches to each fact row the version effective on
  its date: an equi-join on the policy plus an interval predicate.  The
  equi key keeps the join a shuffle (or broadcast) hash/sort-merge join,
  never a nested loop; AQE splits a hot policy's partition.
* ``interval_violations`` flags overlaps and gaps between versions.
* ``splice``             adds a day's changes to the chains of their policies only.
* ``snapshot_diff``      compares two Gold snapshots row by row.

Windows here are partitioned by policy: they order the versions of one
policy, whose number is small by nature (changes, not facts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def change_violations(changes: DataFrame, policies: DataFrame) -> DataFrame:
    """(policy_change_id, policy_id, problems) for every invalid change."""
    by_update = Window.partitionBy("policy_id").orderBy("source_updated_at", "policy_change_id")
    known = policies.select("policy_id").distinct().withColumn("_known", F.lit(True))
    c = F.col
    rows = (
        changes.join(known, "policy_id", "left")
        .withColumn("_previous_version", F.lag("source_version").over(by_update))
    )
    problems = F.concat_ws(
        "; ",
        F.when(c("_known").isNull(), F.lit("policy does not exist")),
        F.when(c("source_version") <= c("_previous_version"), F.lit("source_version does not increase")),
        F.when(c("effective_date") < F.to_date("source_updated_at"),
               F.lit("effective_date is before the update's business date")),
    )
    return rows.select("policy_change_id", "policy_id", problems.alias("problems")).filter(F.length("problems") > 0)


def scd2(changes: DataFrame, key: str = "policy_id", effective: str = "effective_date") -> DataFrame:
    """One row per version with [valid_from, valid_to) and a version number."""
    # two changes that take effect on one day are told apart by what else orders them
    ties = [c for c in ("source_version", "source_updated_at", "policy_change_id") if c in changes.columns]
    ordered = Window.partitionBy(key).orderBy(effective, *ties)
    return (
        changes.withColumn("valid_from", F.col(effective))
        .withColumn("valid_to", F.lead(effective).over(ordered))
        .withColumn("version_number", F.row_number().over(ordered))
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def as_of_join(facts: DataFrame, history: DataFrame, key: str, fact_date: str,
               attributes: list[str]) -> DataFrame:
    """Each fact row with the attributes of the version effective on its
    date; facts before the first version keep NULL attributes (left join)."""
    h = history.select(F.col(key).alias("_k"), "valid_from", "valid_to", *attributes)
    cond = (
        (F.col(key) == F.col("_k"))
        & (F.col(fact_date) >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col(fact_date) < F.col("valid_to")))
    )
    return facts.join(h, cond, "left").drop("_k")


def interval_violations(history: DataFrame, key: str = "policy_id") -> DataFrame:
    """Overlaps and gaps between the versions of one key, nested ones included.

    A sweep in order of ``valid_from`` against the furthest end so far (an open end reaches for
    ever), not against the neighbour alone: [1,10), [2,3), [3,4) overlap twice.  The sweep runs
    by key and year; what earlier years reach is one small row per key and year, so the versions
    of a hot key are spread over tasks."""
    never = F.lit("9999-12-31").cast("date")
    rows = history.select(key, "valid_from", "valid_to", F.coalesce("valid_to", never).alias("_end"), F.year("valid_from").alias("_year"))
    earlier = Window.partitionBy(key).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy(key, "_year").agg(F.max("_end").alias("_far")).select(
        F.col(key).alias("_key"), F.col("_year").alias("_in_year"), F.max("_far").over(earlier).alias("_carried"))
    sweep = Window.partitionBy(key, "_year").orderBy("valid_from", "_end").rowsBetween(Window.unboundedPreceding, -1)
    swept = rows.withColumn("_reach", F.max("_end").over(sweep)).join(
        carried, F.col(key).eqNullSafe(F.col("_key")) & F.col("_year").eqNullSafe(F.col("_in_year")), "left")
    reach = F.greatest("_reach", "_carried")  # NULL for the first version of a key
    return swept.where(reach != F.col("valid_from")).select(
        key, "valid_from", "valid_to", F.nullif(reach, never).alias("previous_valid_to"),
        F.when(reach > F.col("valid_from"), "overlap").otherwise("gap").alias("problem"))


def splice(history: DataFrame, changes: DataFrame, key: str = "policy_id", change_id: str = "policy_change_id",
           parts: int | None = None) -> DataFrame:
    """``history`` (as ``scd2`` gives it) with further changes: only the chains of the changed keys are
    built again, all other rows pass through.  A change that the history already holds is replaced, so
    a load that runs twice gives the same history.  Only ids look for changes held already, as those are
    few; the rows stay where their keys are.  ``parts``: parts that the chains are built in."""
    own = changes.columns
    touched = changes.select(key).distinct()
    held = staged(changes.select(change_id).join(history.select(change_id), change_id, "left_semi"), "changes-held")
    kept = history.join(touched, key, "left_semi").join(held, change_id, "left_anti").select(own)
    rows = kept.unionByName(changes)
    chains = scd2(rows.repartition(parts, key) if parts else rows, key)
    return history.join(touched, key, "left_anti").select(chains.columns).unionByName(chains)


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows only in one snapshot, tagged 'removed' or 'added' (bag semantics): each is read once, and a row
    is given as often as one side holds it more than the other."""
    if dict(before.dtypes) != dict(after.dtypes):
        raise ValueError(f"the snapshots differ in their columns: {sorted(set(before.dtypes) ^ set(after.dtypes))}")
    columns = [F.col(f"`{c}`") for c in before.columns]
    both = before.select(*columns, F.lit(1).alias("_more")).unionAll(after.select(*columns, F.lit(-1).alias("_more")))
    uneven = both.groupBy(*columns).agg(F.sum("_more").alias("_more")).where("_more <> 0")
    return uneven.withColumn("change", F.when(F.col("_more") > 0, "removed").otherwise("added")).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.abs("_more")))).select(*columns, "change")


def snapshot_cells(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What changed between two snapshots, cell by cell: (key, change, column, before, after).

    One full outer join on the key; rows on one side only are 'added' or 'removed' (no column named),
    rows on both sides give one line per column whose values differ, NULLs compared as values."""
    if dict(before.dtypes) != dict(after.dtypes):
        raise ValueError(f"the snapshots differ in their columns: {sorted(set(before.dtypes) ^ set(after.dtypes))}")
    columns = [c for c in before.columns if c != key]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias(f"_{name}_key"), F.struct(*columns).alias(name))

    both = side(before, "b").join(side(after, "a"), F.col("_b_key").eqNullSafe(F.col("_a_key")), "full")
    line = lambda change, column=None, old=None, new=None: F.struct(
        F.lit(change).alias("change"), F.lit(column).cast("string").alias("column"),
        (F.lit(None) if old is None else old).cast("string").alias("before"), (F.lit(None) if new is None else new).cast("string").alias("after"))
    cells = [F.when(~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")), line("changed", c, F.col(f"b.{c}"), F.col(f"a.{c}"))) for c in columns]
    lines = F.when(F.col("b").isNull(), F.array(line("added"))).when(F.col("a").isNull(), F.array(line("removed"))) \
        .otherwise(F.array_compact(F.array(*cells)))
    return both.select(F.coalesce("_b_key", "_a_key").alias(key), F.inline(lines))


def generation_digest(df: DataFrame) -> DataFrame:
    """(rows, digest) of a table, the same for every order and partitioning of its rows: the sum of the
    leading 60 bits of each row's MD5.  Equal digests of an old date's generations show that a later
    load left the date unchanged."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("<null>")) for c in sorted(df.columns)])
    part = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").alias("digest"))
