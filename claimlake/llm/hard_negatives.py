"""Hard negatives from Hilbert-ordered blocks with zone maps.

Rows are sorted along a Hilbert curve through their most varying dimensions and cut
into blocks; a block is one row of a Parquet table: ids, labels, the vectors as one
binary matrix and, as a zone map, the least and greatest value of every dimension.
A window asks for the best k scores between two limits.  For an anchor and a block,
interval arithmetic on the zone map bounds every inner product from both sides, so
a window reads a block only if its limits and those bounds overlap.  Each window is
first narrowed in the anchor's own block: below its k-th best score nothing counts.

The operator runs this twice: an open window over rows of the anchor's label gives
its positives, then each positive's window over rows of other labels gives its hard
negatives.

Anchors are dealt into parts along the curve.  Zone maps (about a thousandth of the
rows) meet every part; a block's rows go only to parts that ask for it, a task holds
one block and one part of anchors, and nothing whole is collected or broadcast.  The
driver sees sums per dimension, two row counts and the width.

Where values vary alike and independently in many dimensions, every block's interval
is wide and all blocks are read; results stay exact, and the work is then that of
comparing the stated anchors with all rows.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; shorter vectors count as padded with zeros; an anchor's own
row is never its partner, other rows with its id are; repeated anchor rows are
answered each for itself; ties go to the smaller id; a label without other rows
gives no positives, an empty table no rows; columns other than the three are not
read; very long vectors make blocks of fewer rows.  Products must fit a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import staged, tune

BLOCK_BYTES = 1 << 19   # of a block's matrix; the number of its rows follows from the width
PART = 4_096            # anchors of a part, about
ZONE_BYTES = 1 << 22    # of the zone maps that meet a part in one task
CURVE_DIMENSIONS = 8    # dimensions that the curve runs through
CURVE_BITS = 6          # cells per dimension, as a power of two
LEAST, MOST = -2 ** 63, 2 ** 63 - 1

BLOCKS = ("block long, rows array<long>, ids array<long>, labels array<long>, vectors binary, "
          "low array<double>, high array<double>, kinds array<long>")
ANCHORS = "row long, vec_id long, label long, vec array<long>, home long, windows array<struct<window:int,low:long,high:long>>"
HITS = "anchor_row long, window int, row long, vec_id long, score long"


def hilbert_rank(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (n, d) along a Hilbert curve; d * bits must be below 64.

    The cell's bits are taken level by level.  At each level the sub-cube is found in
    Gray order of the axes as they lie there, then the axes are swapped and mirrored for
    the level below; both are kept per point as a permutation and a mirror mask."""
    n, d = cells.shape
    cells = cells.astype(np.int64)
    turn, mirror = np.zeros(n, np.int64), np.zeros(n, np.int64)
    place = np.zeros(n, np.int64)
    full = (1 << d) - 1
    for level in range(bits - 1, -1, -1):
        corner = np.zeros(n, np.int64)
        for axis in range(d):
            corner |= (cells[:, axis] >> level & 1) << axis
        corner ^= mirror
        shift = turn + 1
        corner = (corner >> shift | corner << (d - shift)) & full  # rotate right; shift lies in 1..d
        number = corner.copy()                                     # Gray code to its rank
        step = 1
        while step < d:
            number ^= number >> step
            step <<= 1
        place = place << d | number
        before = np.where(number == 0, 0, (number - 1) // 2 * 2)
        entry = before ^ before >> 1                               # corner where the sub-curve starts
        mirror ^= (entry << shift | entry >> (d - shift)) & full
        low = np.where(number == 0, 0, np.where(number % 2 == 0, number - 1, number))
        ones = np.zeros(n, np.int64)                               # trailing ones give the sub-curve's axis
        live = low & 1
        while live.any():
            ones += live
            low = low >> 1
            live = live & low
        turn = (turn + ones % d + 1) % d
    return place


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _spread(rows: DataFrame, width: int) -> list[tuple[int, float, float]]:
    """(dimension, mean, deviation) of the most varying dimensions, from sums over all rows."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total, square = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            m = _matrix(batch["vec"], width).astype(float)
            n, total, square = n + len(m), total + m.sum(0), square + (m * m).sum(0)
        yield pd.DataFrame({"dim": np.arange(width), "n": float(n), "total": total, "square": square})

    found = rows.select("vec").mapInPandas(sums, "dim int, n double, total double, square double") \
        .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("square").alias("s")).collect()
    each = [(r["dim"], r["t"] / r["n"], math.sqrt(max(r["s"] / r["n"] - (r["t"] / r["n"]) ** 2, 0))) for r in found if r["n"]]
    return sorted(each, key=lambda e: (-e[2], e[0]))[:CURVE_DIMENSIONS]


def _on_curve(rows: DataFrame, spread: list[tuple[int, float, float]]) -> DataFrame:
    """``rows`` with ``place``, their cell's rank on the curve."""
    fields = "row long, vec_id long, label long, vec array<long>, place long"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dims = [d for d, _, _ in spread]
        mean, deviation = np.array([m for _, m, _ in spread]), np.array([max(s, 1e-9) for _, _, s in spread])
        for batch in batches:
            at = np.array([[v[d] if d < len(v) else 0 for d in dims] for v in batch["vec"]], float).reshape(len(batch), len(dims))
            cells = np.clip(((at - mean) / deviation + 2) / 4 * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1)
            yield batch.assign(place=hilbert_rank(cells.astype(np.int64), CURVE_BITS) if dims else np.zeros(len(batch), np.int64))

    return rows.mapInPandas(place, fields)


def blocks_of(rows: DataFrame, width: int, count: int) -> DataFrame:
    """The block table of ``rows`` (row, vec_id, label, vec), in curve order."""
    size = max(16, BLOCK_BYTES // (8 * max(width, 1)))
    placed = staged(_on_curve(rows, _spread(rows, width)), "hilbert")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, number, held = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) >= size:
                yield block(first + number, held[:size])
                held, number = held[size:].reset_index(drop=True), number + 1
        if held is not None and len(held):
            yield block(first + number, held)

    def block(number: int, part: pd.DataFrame) -> pd.DataFrame:
        m = _matrix(part["vec"], width)
        return pd.DataFrame({
            "block": [number], "rows": [part["row"].to_numpy()], "ids": [part["vec_id"].to_numpy()],
            "labels": [part["label"].to_numpy()], "vectors": [m.astype("<i8").tobytes()],
            "low": [m.min(0).astype(float)], "high": [m.max(0).astype(float)], "kinds": [np.unique(part["label"])]})

    # Equal places are split by the row, so a vector that many rows share fills several partitions.
    tasks = max(1, math.ceil(count / (16 * size)))
    along = placed.repartitionByRange(tasks, "place", F.xxhash64("row")).sortWithinPartitions("place", F.xxhash64("row"))
    return staged(along.mapInPandas(cut, BLOCKS), "blocks")


def _asked(anchors: pd.DataFrame, zones: pd.DataFrame, same: bool) -> pd.DataFrame:
    """(block, part, row) where the block's bounds meet one of the anchor's windows."""
    if not len(anchors) or not len(zones):
        return pd.DataFrame({"block": pd.Series([], dtype="int64"), "row": pd.Series([], dtype="int64")})
    low, high = np.stack(zones["low"].to_list()), np.stack(zones["high"].to_list())
    wanted = np.zeros((len(anchors), len(low)), bool)
    for start in range(0, len(anchors), 256):
        a = _matrix(anchors["vec"].iloc[start:start + 256], low.shape[1]).astype(float)
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T)  # rounding of the bounds
        most = up @ high.T + down @ low.T + slack
        least = up @ low.T + down @ high.T - slack
        for i, windows in enumerate(anchors["windows"].iloc[start:start + 256]):
            for w in windows:
                wanted[start + i] |= (most[i] >= w["low"]) & (least[i] <= w["high"])
    kinds = [set(np.asarray(k).tolist()) for k in zones["kinds"]]
    labels = anchors["label"].to_numpy()
    for label in np.unique(labels):
        useful = np.array([label in k if same else bool(k - {int(label)}) for k in kinds])
        wanted[labels == label] &= useful
    at, which = np.nonzero(wanted)
    return pd.DataFrame({"block": zones["block"].to_numpy()[which], "row": anchors["row"].to_numpy()[at]})


def _read(anchors: pd.DataFrame, block: pd.DataFrame, same: bool, k: int) -> pd.DataFrame:
    """The k best scores of one block in every window of the anchors that ask for it."""
    names = [c.split()[0] for c in HITS.split(", ")]
    if not len(anchors) or not len(block):
        return pd.DataFrame({c: pd.Series([], dtype="int64") for c in names})
    rows, ids, labels = (np.asarray(block[c].iloc[0]) for c in ("rows", "ids", "labels"))
    m = np.frombuffer(block["vectors"].iloc[0], "<i8").reshape(len(rows), -1)
    out: list[list] = [[] for _ in names]
    exact = float(np.abs(m).max(initial=0)) * m.shape[1]
    for start in range(0, len(anchors), 256):
        some = anchors.iloc[start:start + 256]
        a = _matrix(some["vec"], m.shape[1])
        if exact * float(np.abs(a).max(initial=0)) < 2 ** 53:
            scores = (a.astype(float) @ m.T.astype(float)).astype(np.int64)
        else:
            scores = a @ m.T
        for i, (row, label, windows) in enumerate(zip(some["row"].tolist(), some["label"].tolist(), some["windows"])):
            fits = (labels == label) & (rows != row) if same else labels != label
            for w in windows:
                at = np.flatnonzero(fits & (scores[i] >= w["low"]) & (scores[i] <= w["high"]))
                if len(at) > k:
                    at = at[scores[i][at] >= np.partition(scores[i][at], len(at) - k)[len(at) - k]]
                at = at[np.lexsort((ids[at], -scores[i][at]))[:k]]
                for column, values in zip(out, ([row] * len(at), [w["window"]] * len(at), rows[at], ids[at], scores[i][at])):
                    column.extend(values)
    return pd.DataFrame({c: np.array(v, np.int64) for c, v in zip(names, out)})


def _best_in(anchors: DataFrame, asks: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    """Hits of the anchors in the blocks they ask for: ``asks`` holds (block, part, row)."""
    wanted = asks.select(F.col("block").alias("wanted"), F.col("part").alias("by")).distinct()
    needed = wanted.join(blocks.select("block", "rows", "ids", "labels", "vectors"), F.col("wanted") == F.col("block"))
    asking = asks.select(F.col("block").alias("asked"), F.col("part").alias("asked_by"), "row").join(anchors.drop("part", "home"), "row")
    return asking.groupBy("asked", "asked_by").cogroup(needed.groupBy("wanted", "by")) \
        .applyInPandas(lambda a, b: _read(a, b, same, k), HITS)


def windows_read(anchors: DataFrame, blocks: DataFrame, same: bool, k: int) -> tuple[DataFrame, DataFrame]:
    """(hits, asks): the k best rows of each window, and which block each anchor read for them.

    ``anchors``: ANCHORS and ``part``; rows of the anchor's label if ``same``, else of the others."""
    ranked = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "vec_id", "row")
    home = _best_in(anchors, anchors.select(F.col("home").alias("block"), "part", "row"), blocks, same, k)
    reached = home.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k) \
        .groupBy(F.col("anchor_row").alias("row")).agg(F.map_from_entries(
            F.collect_list(F.struct("window", "score"))).alias("floor"))  # one entry per window of the anchor
    narrowed = staged(anchors.join(reached, "row", "left").withColumn("windows", F.transform("windows", lambda w: F.struct(
        w["window"].alias("window"),
        F.greatest(w["low"], F.coalesce(F.try_element_at("floor", w["window"]), w["low"])).alias("low"),
        w["high"].alias("high")))).drop("floor"), "windows")
    parts = (narrowed.agg(F.max("part")).first()[0] or 0) + 1
    zones = blocks.select("block", "low", "high", "kinds")
    count, width = zones.agg(F.count("*"), F.max(F.size("low"))).first()
    zone_parts = max(1, math.ceil(count * 16 * (width or 1) / ZONE_BYTES))
    zones = zones.withColumn("zone_part", F.pmod(F.xxhash64("block"), F.lit(zone_parts))) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    spread = narrowed.withColumn("zone_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(zone_parts - 1).cast("long"))))

    def ask(key, a: pd.DataFrame, z: pd.DataFrame) -> pd.DataFrame:
        return _asked(a, z, same).assign(part=int(key[1]))[["block", "part", "row"]]

    asks = staged(spread.groupBy("zone_part", "part").cogroup(zones.groupBy("zone_part", "part"))
                  .applyInPandas(ask, "block long, part int, row long"), "asks")
    hits = _best_in(narrowed, asks, blocks, same, k)
    return hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), asks


def _window(window: Column, low: Column, high: Column) -> Column:
    return F.struct(window.cast("int").alias("window"), low.cast("long").alias("low"), high.cast("long").alias("high"))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, k: int = 10, low: int = 30, high: int = 90,
                   factor: int = 256, key: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """anchor_row, anchor_id, positive, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on ``vec_id``; negatives score between ``low`` and ``high`` per cent of the positive."""
    tune(vectors.sparkSession)
    x = F.col(vector)
    good = F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    rows = staged(vectors.where(F.coalesce(good, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(F.lit(factor) * v.cast("double"))).alias("vec")), "vectors")
    width, count = rows.agg(F.max(F.size("vec")), F.count("*")).first()
    blocks = blocks_of(rows, max(width or 0, 1), count)
    home = blocks.select("block", F.explode(F.arrays_zip("rows", "ids")).alias("member")) \
        .select(F.col("block").alias("home"), F.col("member.rows").alias("row"), F.col("member.ids").alias("vec_id"))
    anchors = rows.join(home.where(is_anchor).select("row", "home"), "row")
    parts = max(1, math.ceil(rows.where(is_anchor).count() / PART))
    anchors = staged(anchors.repartitionByRange(parts, "home", "row").withColumn("part", F.spark_partition_id())
                     .withColumn("windows", F.array(_window(F.lit(0), F.lit(LEAST), F.lit(MOST)))), "anchors")
    near, _ = windows_read(anchors, blocks, True, positives)
    near = staged(near.select(F.col("anchor_row").alias("row"), F.col("rank").alias("positive"), F.col("vec_id").alias("positive_id"),
                              F.col("score").alias("positive_score")), "positives")
    limits = near.where(F.col("positive_score") >= 0).groupBy("row").agg(F.collect_list(_window(  # `positives` entries at most
        F.col("positive"), F.expr(f"(positive_score * {int(low)} + 99) div 100"),
        F.expr(f"positive_score * {int(high)} div 100"))).alias("windows"))
    asking = staged(anchors.drop("windows").join(limits, "row"), "anchors")
    far, _ = windows_read(asking, blocks, False, k)
    return far.select(F.col("anchor_row"), F.col("window").alias("positive"), "rank", F.col("vec_id").alias("negative_id"),
                      F.col("score").alias("negative_score")) \
        .join(near.withColumnRenamed("row", "anchor_row"), ["anchor_row", "positive"]) \
        .join(anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row") \
        .select("anchor_row", "anchor_id", "positive", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
