"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length (a geometric scale), longest first, and each
group is cut into blocks of bounded size.  The longest blocks give each query a
first threshold.  A query then visits a group only if its length times the group's
greatest length can reach that threshold.  Inside a block the threshold divided by
both lengths is a local cosine threshold: where it is low, candidates are pruned by
length alone; where it is high, by the products on a few heavy coordinates plus the
Cauchy-Schwarz bound of the rest.  Survivors are verified with exact products.

Queries and candidates meet in tasks of at most ``BLOCK`` candidates and
``QUERY_BLOCK`` queries; nothing whole is collected or broadcast, only the number
of rows and the greatest length of each group (the scale bounds their number).

Defined cases: vectors that are null or hold a null or non-finite component take
no part, nor do rows without an id; shorter vectors count as padded with zeros;
a query's own row is no candidate, other rows with its id are, and repeated query
rows are answered each for itself; ties go to the smaller id; fewer candidates
than k give them all; an empty table gives an empty result.  Products must fit a
long.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlake.llm.common import staged, tune

SCALE = 1.05            # lengths of a group differ by this factor at most
BLOCK = 8_192
QUERY_BLOCK = 1_024
SEED_ROWS = 2_048       # candidates that give the first threshold, at least (if there are as many)
COORDINATES_FROM = 0.3  # local cosine threshold from which coordinates prune
HEAVY = 16              # coordinates used to prune

PAIRS = "query_row long, query_id long, vec_id long, score long"


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products, in floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k best: highest score, then smallest id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _search(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of these candidates for each query, as far as they can reach its threshold."""
    if not len(queries) or not len(candidates):
        return pd.DataFrame({c.split()[0]: pd.Series([], dtype="int64") for c in PAIRS.split(", ")})
    candidates = candidates.sort_values("norm", ascending=False, kind="stable")
    width = max(max(map(len, queries["vec"])), max(map(len, candidates["vec"])), 1)
    q, c = _matrix(queries["vec"], width), _matrix(candidates["vec"], width)
    q_norm, c_norm = queries["norm"].to_numpy(float), candidates["norm"].to_numpy(float)
    floor = queries["threshold"].to_numpy(float)
    ids, rows = candidates["vec_id"].to_numpy(np.int64), candidates["row"].to_numpy(np.int64)
    heavy = np.argsort(-np.square(q.astype(float)).sum(0))[:HEAVY]
    q_heavy, c_heavy = q[:, heavy].astype(float), c[:, heavy].astype(float)
    q_rest = np.sqrt(np.maximum(q_norm ** 2 - np.square(q_heavy).sum(1), 0))
    c_rest = np.sqrt(np.maximum(c_norm ** 2 - np.square(c_heavy).sum(1), 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.nan_to_num(floor / (q_norm * c_norm[0]), nan=-1.0, posinf=2.0, neginf=-1.0)
    out = []
    dense = np.flatnonzero(~(cosine >= COORDINATES_FROM))
    dense_scores = _products(q[dense], c)
    at_dense = {int(n): i for i, n in enumerate(dense)}
    for n, (row, name) in enumerate(zip(queries["row"].tolist(), queries["vec_id"].tolist())):
        # by length: |q| |c| >= threshold holds for a prefix of the candidates
        last = len(c)
        if floor[n] > 0:
            last = int(np.searchsorted(-c_norm * q_norm[n], -floor[n] * (1 - 1e-9), side="right"))
        if n in at_dense:
            keep = np.arange(last)
            scores = dense_scores[at_dense[n], :last]
        else:  # by coordinates: heavy products plus the bound of the rest
            bound = c_heavy[:last] @ q_heavy[n] + c_rest[:last] * q_rest[n]
            keep = np.flatnonzero(bound >= floor[n] - 1e-6 * (1 + abs(floor[n])))
            scores = _products(q[n:n + 1], c[keep])[0]
        other = (rows[keep] != row) & (scores >= floor[n])
        keep, scores = keep[other], scores[other]
        best = _best(scores, ids[keep], k)
        out += [(row, name, int(ids[keep[i]]), int(scores[i])) for i in best]
    return pd.DataFrame(out, columns=[c.split()[0] for c in PAIRS.split(", ")])


def whole_vectors(vectors: DataFrame, key: str, vector: str, factor: int = 1024) -> DataFrame:
    """row, vec_id, vec (floor of factor times each component), norm; rows that take no part are left out."""
    x = F.col(vector)
    good = F.col(key).isNotNull() & x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    rows = vectors.where(F.coalesce(good, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(F.lit(factor) * v.cast("double"))).alias("vec"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))))


def _blocks_of(group: int, blocks: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)),
                       lambda block: F.struct(F.lit(group).alias("group"), block.alias("block")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_row, query_id, rank, vec_id, score.  ``is_query`` is a condition on ``vec_id``."""
    tune(vectors.sparkSession)
    group = F.when(F.col("norm") > 0, F.floor(F.log(F.col("norm")) / math.log(SCALE))).otherwise(F.lit(-1_000_000)).cast("int")
    every = staged(whole_vectors(vectors, key, vector).withColumn("group", group), "vectors")
    # one row per length group
    groups = [(r["group"], r["n"], r["longest"]) for r in every.groupBy("group").agg(
        F.count("*").alias("n"), F.max("norm").alias("longest")).orderBy(F.desc("group")).collect()]
    blocks = {g: math.ceil(n / BLOCK) for g, n, _ in groups}
    count = F.lit(1)
    for g, b in blocks.items():
        if b > 1:
            count = F.when(F.col("group") == g, b).otherwise(count)
    every = every.withColumn("block", F.pmod(F.xxhash64("row"), count).cast("int"))
    queries = staged(every.where(is_query).drop("block", "group"), "queries")
    parts = max(1, math.ceil(queries.count() / QUERY_BLOCK))
    queries = queries.withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts)).cast("int"))

    seeds, enough = [], 0
    for g, n, _ in groups:  # whole blocks, longest first
        for b in range(blocks[g]):
            if enough < SEED_ROWS:
                seeds.append((g, b))
                enough += n / blocks[g]

    def meet(asking: DataFrame, candidates: DataFrame) -> DataFrame:
        spread = candidates.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return spread.groupBy("group", "block", "part").cogroup(asking.groupBy("group", "block", "part")) \
            .applyInPandas(lambda c, q: _search(q, c, k), PAIRS)

    is_seed = F.lit(False)
    for g, b in seeds:
        is_seed = is_seed | ((F.col("group") == g) & (F.col("block") == b))
    at_seeds = F.explode(F.array(*[F.struct(F.lit(g).alias("group"), F.lit(b).alias("block")) for g, b in seeds] or
                                 [F.struct(F.lit(0).alias("group"), F.lit(0).alias("block"))]))
    first = staged(meet(queries.withColumn("threshold", F.lit(float("-inf"))).withColumn("at", at_seeds).select("*", "at.*").drop("at"),
                        every.where(is_seed)), "first-hits")
    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    found = first
    if len(seeds) < sum(blocks.values()):
        floor = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k) \
            .select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("threshold"))
        asking = queries.join(staged(floor, "thresholds"), "row", "left") \
            .withColumn("threshold", F.coalesce("threshold", F.lit(float("-inf"))))
        reach = F.explode(F.flatten(F.array(*[
            F.when((F.col("threshold") <= 0) | (F.col("norm") * longest >= F.col("threshold") * (1 - 1e-9)),
                   _blocks_of(g, blocks[g]))
            .otherwise(F.array().cast("array<struct<group:int,block:int>>"))
            for g, _, longest in groups])))
        asking = asking.withColumn("at", reach).select("*", "at.*").drop("at").where(~is_seed)
        found = first.union(meet(asking, every.where(~is_seed)))
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k) \
        .select("query_row", "query_id", "rank", "vec_id", "score")
