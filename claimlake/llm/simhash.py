"""SimHash near-duplicates over a Gray-order hierarchical index.

A document's fingerprint has a bit for each of the 64 bits that is set in more
than half of its word shingles' XXH64 values.  Two fingerprints link when they
differ in at most ``max_bits`` bits; a component is what links connect.

Distinct fingerprints are dealt by ``max_bits + 1`` bands of their bits (two that
link agree in one band at least), so each is sent ``max_bits + 1`` times and each
task holds a bounded number.  Within a band value the fingerprints are sorted by
their rank in Gray order, where neighbours differ in few bits, and indexed as a
tree: a node holds the bits that all below it share and that no node above holds
already.  A search walks down with the differences met so far and leaves out a
whole group once they exceed ``max_bits``.  A task returns only a spanning forest
of the links it found; union-find joins the forests.

A band value that very many fingerprints share is cut into blocks, and its blocks
are searched in pairs, so that no task holds more than two blocks.

Defined cases: null and empty texts have fingerprint zero, which links like any
other; texts with fewer words than a shingle have one shingle, the whole text;
equal texts have equal fingerprints and are one component; a null document id is
never the smallest unless all are null; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import connected_components, free_name, staged, tune, words_of

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCK = 8_192           # fingerprints of one band value that a task holds, at most two blocks
TASK_ROWS = 100_000     # rows of small band values that a task holds, on average
FAN = 8                 # children of a node


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of the lower-cased word shingles (A-Z only), as an unsigned number."""
    words = words_of(text.lower() if text else None)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    hash_ = xxhash.xxh64_intdigest
    hashes = np.array([hash_(joined[a:b], SEED) for a, b in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())], "<u8")
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)]
        set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long with the same bits."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(text.cast("binary"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code word in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A tree over fingerprints in Gray order; a node keeps the shared bits that its parent does not."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        every = codes[self.order]
        self.levels = []  # from the leaves up: (bits all below share, bits set in all below)
        ones, zeros = every, ~every
        while True:
            self.levels.append((ones | zeros, ones))
            if len(ones) <= FAN:
                break
            cuts = np.arange(0, len(ones), FAN)
            ones, zeros = np.bitwise_and.reduceat(ones, cuts), np.bitwise_and.reduceat(zeros, cuts)

    def search(self, queries: np.ndarray, most: int, chunk: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query numbers, numbers of the indexed codes) with at most ``most`` differing bits, chunk by chunk."""
        for at in range(0, len(queries), chunk):
            part = queries[at:at + chunk]
            mask, pattern = self.levels[-1]
            query = np.repeat(np.arange(len(part)), len(mask))
            node = np.tile(np.arange(len(mask)), len(part))
            met = np.zeros(len(node), np.uint8)
            held = np.zeros(len(node), np.uint64)  # bits compared further up
            for level in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[level]
                met = met + np.bitwise_count((part[query] ^ pattern[node]) & (mask[node] & ~held))
                near = met <= most
                query, node, met = query[near], node[near], met[near]
                if level:
                    held = np.repeat(mask[node], FAN)
                    query, met = np.repeat(query, FAN), np.repeat(met, FAN)
                    node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                    there = node < len(self.levels[level - 1][0])
                    query, node, met, held = query[there], node[there], met[there], held[there]
            yield query + at, self.order[node]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union-find in place: the smallest number of each set becomes the label of all in it."""
    while True:
        least = np.minimum(labels[a], labels[b])
        changed = (labels[a] != least) | (labels[b] != least)
        if not changed.any():
            return
        np.minimum.at(labels, labels[a], least)
        np.minimum.at(labels, labels[b], least)
        np.minimum.at(labels, a, least)
        np.minimum.at(labels, b, least)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def _forest(codes: np.ndarray, runs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each run (sorted) of codes."""
    labels = np.arange(len(codes))
    starts = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]]))
    sizes = np.diff(np.append(starts, len(codes)))
    short = np.repeat(sizes <= 4 * FAN, sizes)
    longest = int(sizes[sizes <= 4 * FAN].max(initial=1))
    for step in range(1, longest):  # short runs: compare with the next, the one after, ...
        i = np.flatnonzero(short[:-step] & (runs[:-step] == runs[step:]))
        i = i[np.bitwise_count(codes[i] ^ codes[i + step]) <= most]
        merge_labels(labels, i, i + step)
    for start, size in zip(starts[sizes > 4 * FAN], sizes[sizes > 4 * FAN]):
        own = codes[start:start + size]
        for a, b in GrayIndex(own).search(own, most):
            merge_labels(labels, a + start, b + start)
    moved = np.flatnonzero(labels != np.arange(len(codes)))
    return moved, labels[moved]


def links(codes: DataFrame, max_bits: int = MAX_BITS, bits: int = 64) -> DataFrame:
    """(a, b): a spanning forest, per task, of all links among the distinct ``code`` longs of ``codes``."""
    bands = max_bits + 1
    edges = [round(k * bits / bands) for k in range(bands + 1)]
    dealt = codes.select("code", F.explode(F.array(*[
        F.struct(F.lit(k).alias("band"), F.shiftrightunsigned("code", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
        for k, (lo, hi) in enumerate(zip(edges, edges[1:]))])).alias("b")).select("code", "b.band", "b.value")
    n = codes.count()
    tasks = max(1, math.ceil(bands * n / TASK_ROWS))
    # Band values that more than a block of fingerprints share; fewer than bands * n / BLOCK rows.
    heavy = staged(dealt.groupBy("band", "value").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
                   .select("band", "value", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "heavy-bands")
    has_heavy = bool(heavy.take(1))
    light = dealt.join(heavy, ["band", "value"], "left_anti") if has_heavy else dealt
    schema = "a long, b long"

    def within(rows: pd.DataFrame) -> pd.DataFrame:
        run = rows["band"].to_numpy(np.int64) << 60 | rows["value"].to_numpy(np.int64)
        order = np.argsort(run, kind="stable")
        code = rows["code"].to_numpy(np.int64)[order]
        a, b = _forest(code.view(np.uint64), run[order], max_bits)
        return pd.DataFrame({"a": code[a], "b": code[b]})

    def between(rows: pd.DataFrame) -> pd.DataFrame:
        """Two blocks of one band value (or one block with itself)."""
        code = rows["code"].to_numpy(np.int64)
        near, far = code[~rows["second"].to_numpy()], code[rows["second"].to_numpy()]
        both = np.concatenate([near, far])
        labels = np.arange(len(both))
        target, shift = (far, len(near)) if len(far) else (near, 0)
        for a, b in GrayIndex(target.view(np.uint64)).search(near.view(np.uint64), max_bits):
            merge_labels(labels, a, b + shift)
        moved = np.flatnonzero(labels != np.arange(len(both)))
        return pd.DataFrame({"a": both[moved], "b": both[labels[moved]]})

    found = light.groupBy(F.pmod(F.xxhash64("band", "value"), F.lit(tasks)).alias("task")) \
        .applyInPandas(lambda rows: within(rows), schema)
    if has_heavy:
        block = F.pmod(F.xxhash64("code"), F.col("blocks")).cast("int")
        pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
            F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"), (F.col("block") > j).alias("second"))))
        pairs = dealt.join(heavy, ["band", "value"]).withColumn("block", block).withColumn("pair", pair) \
            .select("code", "band", "value", "pair.*")
        found = found.union(pairs.groupBy("band", "value", "i", "j").applyInPandas(lambda rows: between(rows), schema))
    return found


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(key, code, component): the fingerprint of each document and the smallest key it is connected with."""
    tune(docs.sparkSession)
    prints = staged(docs.select(F.col(key).alias("key"), fingerprint_column(F.col(text), shingle).alias("code")), "prints")
    codes = staged(prints.groupBy("code").agg(F.min("key").alias("least")), "codes")
    joined = staged(links(codes, max_bits), "links")
    sets = staged(connected_components(joined), "sets")
    named = codes.join(sets, codes["code"] == sets["node"], "left") \
        .select("code", "least", F.coalesce("component", "code").alias("of"))
    first = staged(named.groupBy("of").agg(F.min("least").alias("component")), "firsts")
    named = staged(staged(named, "named").join(first, "of").select("code", "component"), "code-components")
    return prints.join(named, "code").select("key", "code", "component")


def keep_first(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One document of each component (the smallest key; of repeated rows the first), with the columns of ``docs``."""
    number = free_name(docs, "row_number")
    rows = staged(docs.withColumn(number, F.monotonically_increasing_id()), "documents")
    # the smallest (key, row) of a component; rows without a key come last
    whole = free_name(rows, "row_key")
    found = near_duplicates(rows.withColumn(whole, F.struct(F.col(key).isNull().alias("a"), F.col(key).alias("b"), F.col(number).alias("c"))),
                            key=whole, **options)
    kept = staged(found.where(F.col("key") == F.col("component")).select(F.col("key")["c"].alias("kept_row")), "kept")
    # both grow with the corpus: a shuffle at every size
    return rows.join(kept.hint("merge"), rows[number] == kept["kept_row"], "left_semi").select(*docs.columns)
