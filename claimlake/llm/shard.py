"""Histogram sort: documents into shards of near-equal bytes, in the order of a hashed key.

Splitters are found by counting exact bytes below candidate boundaries in all
partitions at once: each round lays ``FAN`` equal probes over the interval in
which each unfinished splitter must lie and narrows it to one probe step, until
a boundary lies within the tolerance of its target.  Equal keys are split on by
the row's number, so no key can be too heavy for a shard.  Then the rows are
exchanged once, sorted, and numbered in their shard from the sizes of the sorted
partitions.

DataFrame functions only.  The driver holds at most ``(n_shards - 1) * FAN``
counts a round.

Defined cases: a null text has size 1; null keys hash like any value; repeated
rows are told apart by their number in the staged table; an empty table gives an
empty result; a row larger than a shard stays whole, its shard is as large as it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import staged

FAN = 512
TOLERANCE = 0.0005      # of a shard's ideal size
TOP = 2 ** 63 - 1       # keys are 0 .. TOP


@dataclass(frozen=True)
class Interval:
    """Where splitters lie: keys ``low <= key < high``; inside one key (``within``) row numbers instead."""

    low: int
    high: int
    below: int              # bytes below it
    within: int | None = None

    @property
    def step(self) -> int:
        return max(1, -(-(self.high - self.low) // FAN))

    def part(self) -> tuple[Column, Column]:
        """Whether a row lies here, and in which probe step."""
        name = "key" if self.within is None else "tie"
        inside = F.col(name) >= F.lit(self.low)
        if self.high < TOP:
            inside = inside & (F.col(name) < F.lit(self.high))
        if self.within is not None:
            inside = inside & (F.col("key") == F.lit(self.within))
        return inside, F.expr(f"({name} - {self.low}) div {self.step}")


def find_splitters(rows: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The lowest (key, tie) of shards 1, 2, ...  ``rows`` has key, tie and size."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    slack = tolerance * total / n_shards
    found: dict[int, tuple[int, int]] = {}
    open_: dict[int, Interval] = {j: Interval(0, TOP, 0) for j in range(1, n_shards)}
    while open_:
        intervals = list(dict.fromkeys(open_.values()))
        which, part = F.lit(None).cast("int"), F.lit(None).cast("long")
        for i, interval in enumerate(intervals):
            inside, place = interval.part()
            which, part = F.when(inside, F.lit(i)).otherwise(which), F.when(inside, place).otherwise(part)
        counts: dict[int, list[tuple[int, int, int]]] = {i: [] for i in range(len(intervals))}
        # at most FAN rows for each of at most n_shards - 1 intervals
        for r in (rows.select(which.alias("which"), part.alias("part"), "size").where(F.col("which").isNotNull())
                  .groupBy("which", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()):
            counts[r["which"]].append((r["part"], r["bytes"], r["rows"]))
        for held in counts.values():
            held.sort()
        for j, interval in list(open_.items()):
            target, below = total * j / n_shards, interval.below
            for part_no, size, n in counts[intervals.index(interval)]:
                if below + size < target:
                    below += size
                    continue
                low = interval.low + part_no * interval.step
                high = min(low + interval.step, interval.high)
                edges = [(abs(below - target), low), (abs(below + size - target), high)]
                near, edge = min(edges)
                if near <= slack or n == 1:
                    found[j] = (edge, 0) if interval.within is None else (interval.within, edge)
                    del open_[j]
                elif high - low == 1:
                    open_[j] = Interval(0, TOP, below, within=low)
                else:
                    open_[j] = replace(interval, low=low, high=high, below=below)
                break
            else:  # the target lies at the interval's end
                found[j] = (interval.high, 0) if interval.within is None else (interval.within, interval.high)
                del open_[j]
    return [found[j] for j in sorted(found)]


def histogram_sort(rows: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` (key long 0 .. TOP, tie long, size long, other columns) with shard int and slot long.

    Rows should be staged: they are read once a round and once for the exchange."""
    shard = F.lit(0)
    for key, tie in find_splitters(rows, n_shards, tolerance):
        shard = shard + F.when((F.col("key") > F.lit(key)) | ((F.col("key") == F.lit(key)) & (F.col("tie") >= F.lit(tie))), 1).otherwise(0)
    order = ["shard", "key", "tie"]
    sorted_rows = staged(
        rows.withColumn("shard", shard).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "sorted")
    partition, ordinal = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit(2 ** 33 - 1))
    # one row for each partition and shard that meet: at most partitions + shards
    runs = sorted_rows.groupBy(partition.alias("partition"), F.col("shard").alias("of")).agg(
        F.min(ordinal).alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("of").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    return (sorted_rows.join(F.broadcast(starts), (partition == F.col("partition")) & (F.col("shard") == F.col("of")))
            .withColumn("slot", F.col("before") + ordinal - F.col("first"))
            .drop("partition", "of", "first", "before", "place"))


def sharded(docs: DataFrame, n_shards: int = 16, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key column, size, text_crc32, shard, slot of each document."""
    content = F.col(text).cast("binary")
    rows = staged(docs.select(
        F.col(key), (F.coalesce(F.octet_length(content), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(content, F.lit(b""))).alias("text_crc32"),
        F.xxhash64(F.col(key), content).bitwiseAND(F.lit(TOP)).alias("key"),
        F.monotonically_increasing_id().alias("tie")), "sizes")
    return histogram_sort(rows, n_shards).drop("key", "tie")
