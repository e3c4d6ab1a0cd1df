"""Fuzzy line deduplication over the corpus.

Lines (split at \\n, lower-cased A-Z, white space collapsed) with a word take part.  Their
character shingles (a line shorter than a shingle is one as a whole) give a one-permutation MinHash
signature whose bands bring alike lines into the same bucket; candidates are verified
by the exact Jaccard similarity of their shingle sets, and union-find over the verified
pairs makes components.  One line of a component stays, the first by document id, row
and place; the others go.

Exactly equal lines are one line to the search, whatever their number.  In a bucket
every line is verified against the bucket's least line, so that a bucket of thousands
gives thousands of pairs and not millions.  A bucket of three or more whose lines still
lie in several components is then checked across those components, in pairs of bounded
blocks, so that no link within a bucket is lost.  Texts are fetched only for lines that
share a bucket: a bitmap of their hashes, of fixed size, sorts the others out in the
scan (a crowded bitmap costs time, never a line).

Defined cases: null texts have no lines and stay null; empty texts stay; a document that
loses lines and keeps none with a word is dropped by ``deduplicated``;
repeated rows are copies like any other; null ids come after all others; an empty table
gives an empty result; other columns pass untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import connected_components, free_name, staged, tune

SHINGLE = 8             # characters, a power of two
SIMILARITY = 0.8
BANDS, ROWS = 10, 4     # a pair at the threshold shares a bucket with probability 0.995
BLOCK = 256             # lines of a mixed bucket that a task holds, at most two blocks
BITMAP_BITS = 1 << 24
CHUNK = 100_000         # characters hashed at a time
COLUMNS = 8_192         # shingles in one matrix product
GATHERED_CHARS = 2_000_000  # of lines that groups of blocks bring to a task, on average
DONORS = np.stack([np.random.default_rng(i).permutation(BANDS * ROWS) for i in range(BANDS * ROWS)])  # each bin's order


def _signatures(lines: list[str]) -> np.ndarray:
    """One-permutation MinHash: BANDS * ROWS bins; an empty bin borrows from the first full one in an order of its own.

    Neighbours borrow from different bins, so that short lines do not meet for one common shingle.
    No line is shorter than a shingle."""
    bins = BANDS * ROWS
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    codes = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(np.uint64)
    n = len(codes) - SHINGLE + 1
    # a polynomial in the characters of each shingle, from those of its halves
    value, width, factor = codes, 1, 0x9E3779B97F4A7C15
    while width < SHINGLE:
        value = value[:-width] * np.uint64(factor) + value[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    value ^= value >> np.uint64(29)
    value *= np.uint64(0x9FB21C651E98DF25)
    value ^= value >> np.uint64(32)
    ends = np.cumsum(sizes)
    line = np.repeat(np.arange(len(lines)), sizes)[:n]
    inside = np.arange(n) <= ends[line] - SHINGLE
    value, line = value[inside], line[inside]
    low = (value & np.uint64(0xFFFFFFFF)).astype(np.int64)
    slot = line * bins + ((value >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    out = np.full(len(lines) * bins, 1 << 32, np.int64)
    np.minimum.at(out, slot, low)
    out = out.reshape(len(lines), bins)
    full = out != 1 << 32
    row, bin_ = np.nonzero(~full)
    for donor in DONORS.T:
        if not len(row):
            break
        found = full[row, donor[bin_]]
        out[row[found], bin_[found]] = out[row[found], donor[bin_[found]]]
        row, bin_ = row[~found], bin_[~found]
    return out


def _bands(lines: list[str]) -> np.ndarray:
    """A 32-bit bucket per line and band; ``CHUNK`` characters at a time."""
    if not lines:
        return np.zeros((0, BANDS), np.int32)
    lines = [line.ljust(SHINGLE, "\0") for line in lines]
    part = np.cumsum([max(len(line), BANDS * ROWS) for line in lines]) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lines)]
    return np.concatenate([_bands_of(lines[a:b]) for a, b in zip(cuts, cuts[1:])])


def _bands_of(lines: list[str]) -> np.ndarray:
    parts = _signatures(lines).reshape(len(lines), BANDS, ROWS).astype(np.uint64)
    mixed = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407), (len(lines), 1))
    for i in range(ROWS):
        mixed = (mixed ^ parts[:, :, i]) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(28)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _taking_part(text: bytes | None) -> Iterator[tuple[int, bytes]]:
    for place, line in enumerate(text.lower().split(b"\n") if text is not None else ()):
        if clean := b" ".join(line.split()):
            yield place, clean


def _line_hash(line: bytes) -> int:
    h = xxhash.xxh64_intdigest(line)
    return h - (1 << 64) if h >> 63 else h


def line_hashes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, key, n_lines, and for the lines that take part their place, hash and buckets (flat)."""

    @F.pandas_udf("n_lines int, place array<int>, line array<long>, buckets array<int>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [list(_taking_part(t)) for t in texts]
            buckets = _bands([line.decode("utf-8", "replace") for f in found for _, line in f])
            rows, at = [], 0
            for t, f in zip(texts, found):
                rows.append((t.count(b"\n") + 1 if t is not None else 0, np.array([p for p, _ in f], np.int32),
                             np.array([_line_hash(line) for _, line in f], np.int64), buckets[at:at + len(f)].ravel()))
                at += len(f)
            yield pd.DataFrame(rows, columns=["n_lines", "place", "line", "buckets"])

    return docs.select("row", F.col(key).alias("key"), scan(F.col(text).cast("binary")).alias("s")).select("row", "key", "s.*")


def _bitmap(numbers: DataFrame, column: str) -> Broadcast:
    """A bitmap of fixed size with the bits of these numbers set."""
    bit = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    # at most BITMAP_BITS / 32 rows
    held = numbers.select(F.floor(bit / 32).cast("int").alias("at"), F.call_function("shiftleft", F.lit(1), (bit % 32).cast("int")).alias("bit")) \
        .groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(BITMAP_BITS // 32, np.int32)
    bits[held["at"].to_numpy(int)] = held["bits"].to_numpy(np.int64).astype(np.int32)
    return numbers.sparkSession.sparkContext.broadcast(bits.view(np.uint32))


def _may_hold(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether the bitmap holds each number; sometimes true of one that it was not given."""
    at = numbers % BITMAP_BITS
    return (bits[at >> 5] >> (at & 31).astype(np.uint32) & 1).astype(bool)


def _texts_of(docs: DataFrame, text: str, lines: DataFrame) -> DataFrame:
    """(line, words): the normalised text of each of these line hashes, once."""
    sent = _bitmap(lines, "line")

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, seen = sent.value, set()
        for batch in batches:
            found = [line for t in batch["text"] for _, line in _taking_part(t)]
            hashes = np.array([_line_hash(line) for line in found], np.int64)
            out = []
            for i in np.flatnonzero(_may_hold(bits, hashes)).tolist():
                if (h := int(hashes[i])) not in seen:
                    seen.add(h)
                    out.append((h, found[i]))
            if len(seen) > 500_000:
                seen = set()
            yield pd.DataFrame({"line": pd.Series([h for h, _ in out], dtype="int64"), "words": pd.Series([w for _, w in out], dtype=object)})

    found = docs.select(F.col(text).cast("binary").alias("text")).mapInPandas(fetch, "line long, words binary")
    return found.join(lines.select("line").distinct(), "line", "left_semi").groupBy("line").agg(F.first("words").alias("words"))


def _members(lines: DataFrame, shared: DataFrame) -> DataFrame:
    """(line, bucket) for the buckets in ``shared``; most others are sorted out before the join."""
    sent = _bitmap(shared, "bucket")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = _bucket_keys(np.concatenate([*batch["buckets"], np.zeros(0, np.int32)]))
            line = np.repeat(batch["line"].to_numpy(np.int64), BANDS)
            keep = _may_hold(sent.value, keys)
            yield pd.DataFrame({"line": line[keep], "bucket": keys[keep]})

    return lines.mapInPandas(members, "line long, bucket long")


def _bucket_keys(buckets: np.ndarray) -> np.ndarray:
    """A long for each (band, bucket) of flat buckets."""
    band = np.tile(np.arange(BANDS, dtype=np.int64), len(buckets) // BANDS)
    return band << 32 | buckets.astype(np.int64) & 0xFFFFFFFF


def _packed(lines: list[bytes]) -> list[np.ndarray]:
    """The shingles of each line as sorted distinct numbers; equal numbers are equal shingles, within one call.

    The characters met are numbered, and eight numbers below 256 make one long.  With more
    characters than that the shingles themselves are numbered."""
    texts = [line.decode("utf-8", "replace") for line in lines]
    own = np.fromiter(map(len, texts), np.int64, len(texts))
    sizes = np.maximum(own, SHINGLE)
    ends = np.cumsum(sizes)
    codes = np.frombuffer("".join([t.ljust(SHINGLE, "\0") for t in texts]).encode("utf-32-le", "surrogatepass"), "<u4") + np.uint32(1)
    for i in np.flatnonzero(own < SHINGLE).tolist():
        codes[ends[i] - SHINGLE + own[i]:ends[i]] = 0  # no character has this number
    met, number = np.unique(codes, return_inverse=True)
    starts = max(len(codes) - SHINGLE + 1, 0)
    if len(met) <= 256:
        value = np.zeros(starts, np.uint64)
        for i in range(SHINGLE):
            value = value << np.uint64(8) | number[i:i + starts].astype(np.uint64)
    else:
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(codes, SHINGLE)) if starts else np.zeros((0, SHINGLE), "<u4")
        value = np.unique(windows.view(f"V{4 * SHINGLE}").ravel(), return_inverse=True)[1].astype(np.uint64)
    return [_distinct(value[end - size:end - SHINGLE + 1]) for end, size in zip(ends.tolist(), sizes.tolist())]


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    each = np.sort(numbers)
    return each[np.concatenate([[True], each[1:] != each[:-1]])]


def _reaches(both, a, b):
    """Whether sets of a and b shingles, ``both`` of them common, reach the similarity."""
    return both >= SIMILARITY * (a + b - both)


def _alike_matrix(sets: list[np.ndarray]) -> np.ndarray:
    """Which of the lines are alike, by the exact sizes of all their intersections (matrix products over shared shingles).

    The diagonal has no meaning."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    met, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    line = np.repeat(np.arange(len(sets)), sizes)[times[number] > 1]
    column = column[number[times[number] > 1]]
    order = np.argsort(column, kind="stable")
    line, column = line[order], column[order]
    both = np.zeros((len(sets), len(sets)))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (first, first + COLUMNS))
        held = np.zeros((len(sets), min(COLUMNS, int(column[b - 1]) + 1 - first)), np.float32)
        held[line[a:b], column[a:b] - first] = 1
        both += held @ held.T  # counts up to COLUMNS, exact in this type
    return _reaches(both, sizes[:, None], sizes[None, :])


def _across(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between lines of different components, per group of one or two blocks: a spanning forest of each."""
    rows = rows.sort_values(["low", "high", "i", "j"], kind="stable")
    keys = rows[["low", "high", "i", "j"]].to_numpy(np.int64)
    cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    lines, second = rows["line"].to_numpy(np.int64), rows["second"].to_numpy(bool)
    label, words = rows["component"].to_numpy(np.int64).copy(), rows["words"].tolist()
    out = [np.zeros((0, 2), np.int64)]
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
        near = _alike_matrix(_packed(words[start:end]))
        if second[start:end].any():
            near &= second[start:end, None] != second[None, start:end]
        a, b = np.nonzero(np.triu(near, 1))
        a, b = a + start, b + start
        while len(open_ := np.flatnonzero(label[a] != label[b])):
            a, b = a[open_], b[open_]
            out.append(np.array([[lines[a[0]], lines[b[0]]]]))
            of = label[start:end]
            of[of == label[b[0]]] = label[a[0]]
    links = np.concatenate(out)
    return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})


def _joined(sets: DataFrame, more: DataFrame) -> DataFrame:
    """The components ``sets`` (node, component), joined by the links ``more``: a search over components, not lines."""
    of_a, of_b = (sets.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b"))
    edges = more.join(of_a, "a", "left").join(of_b, "b", "left") \
        .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    merged = staged(connected_components(edges, "line-sets"), "line-merged")
    lone = merged.select("node", F.col("node").alias("component")).join(sets, "node", "left_anti")
    return sets.union(lone).join(merged.select(F.col("node").alias("component"), F.col("component").alias("least")), "component", "left") \
        .select("node", F.coalesce("least", "component").alias("component"))


def line_components(hashes: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(line, component) of the line hashes that are alike to another one."""
    band = [f"b{k}" for k in range(BANDS)]  # plain columns: a hash aggregate holds no arrays
    each = hashes.select(F.posexplode("line").alias("i", "line"), "buckets") \
        .select("line", *[F.get("buckets", F.col("i") * BANDS + k).alias(b) for k, b in enumerate(band)])
    distinct = staged(each.groupBy("line").agg(*[F.first(b).alias(b) for b in band]).select("line", F.array(*band).alias("buckets")), "lines")
    of_bucket = F.col("band").cast("long") * (1 << 32) + F.col("b").bitwiseAND(F.lit(0xFFFFFFFF))
    shared = staged(
        distinct.select("line", F.posexplode("buckets").alias("band", "b")).select("line", of_bucket.alias("bucket"))
        .groupBy("bucket").agg(F.min("line").alias("least"), F.max("line").alias("most")).where("least <> most")
        .select("bucket", "least"), "buckets")
    shared = staged(_members(distinct, shared).join(shared, "bucket"), "members")
    pairs = staged(shared.where("line <> least").groupBy("line", "least").agg(F.count("*").alias("n")).select("line", "least"), "pairs")
    texts = staged(_texts_of(docs, text, pairs.select("line").union(pairs.select("least"))), "texts")
    mine, other = texts.withColumnRenamed("words", "x"), texts.select(F.col("line").alias("least"), F.col("words").alias("y"))

    @F.pandas_udf("boolean")
    def verify(x: pd.Series, y: pd.Series) -> pd.Series:
        place: dict[bytes, int] = {}  # a line's set serves all its pairs in the batch
        at = [(place.setdefault(a, len(place)), place.setdefault(b, len(place))) for a, b in zip(x, y)]
        sets = _packed(list(place))

        def linked(a: np.ndarray, b: np.ndarray) -> bool:
            if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
                return False
            each = np.sort(np.concatenate([a, b]))
            return bool(_reaches(np.count_nonzero(each[1:] == each[:-1]), len(a), len(b)))

        return pd.Series([linked(sets[a], sets[b]) for a, b in at], dtype=bool)

    links = staged(pairs.join(mine, "line").join(other, "least").where(verify("x", "y"))
                   .select(F.col("line").alias("a"), F.col("least").alias("b")), "line-links")
    sets = staged(connected_components(links, "line-sets"), "line-components")
    # Buckets of three or more lines that lie in several components still.  What such buckets
    # hold is gathered by the first and last of their components, so that lines which meet
    # in many bands are compared once.
    placed = staged(shared.join(sets, shared["line"] == sets["node"], "left")
                    .select("bucket", "line", F.coalesce("component", "line").alias("component")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")) \
        .where("low <> high and n > 2").select("bucket", "low", "high")
    mixed = staged(mixed, "mixed")
    if mixed.take(1):
        gathered = staged(placed.join(mixed, "bucket").groupBy("low", "high", "line").agg(F.min("component").alias("component")), "gathered")
        blocks = staged(gathered.groupBy("low", "high").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
        block = F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int")
        meet = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
            F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j"), (F.col("block") > j).alias("second"))))
        open_ = gathered.join(blocks, ["low", "high"]).withColumn("block", block).join(texts, "line") \
            .withColumn("meet", meet).select("low", "high", "line", "component", "words", "meet.*")
        # whole groups of blocks, several to a task
        chars = gathered.join(blocks, ["low", "high"]).join(texts, "line").agg(F.sum(F.length("words") * F.col("blocks"))).first()[0]
        tasks = max(1, math.ceil(chars / GATHERED_CHARS))
        task = F.pmod(F.xxhash64("low", "high", "i", "j"), F.lit(tasks))
        more = staged(open_.groupBy(task.alias("task")).applyInPandas(lambda rows: _across(rows), "a long, b long"), "more-links")
        if more.take(1):
            sets = staged(_joined(sets, more), "line-components")
    return sets.select(F.col("node").alias("line"), "component")


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two frames: (row, key, n_lines) of every document, and (row, places) of the lines that go.

    ``docs`` has a column row, different in every row."""
    tune(docs.sparkSession)
    hashes = staged(line_hashes(docs, key, text), "line-hashes")
    sets = line_components(hashes, docs, text)
    every = hashes.select("row", "key", F.explode(F.arrays_zip("place", "line")).alias("z")) \
        .select("row", "key", F.col("z.place").alias("place"), F.col("z.line").alias("line"))
    first = F.min(F.struct(F.col("key").isNull().alias("a"), F.col("key").alias("b"), F.col("row").alias("c"), F.col("place").alias("d")))
    # the first place of each line hash, then of each component
    per_line = every.groupBy("line").agg(first.alias("first"), F.count("*").alias("n"))
    per_line = staged(per_line.join(sets, "line", "left").select(
        "line", "first", "n", F.coalesce("component", "line").alias("component")), "first-places")
    kept = staged(per_line.groupBy("component").agg(F.min("first").alias("kept"), F.sum("n").alias("n")).where("n > 1")
                  .select("component", "kept"), "kept-places")
    affected = staged(per_line.join(kept, "component").select("line", "kept"), "affected")
    gone = every.join(affected, "line").where((F.col("row") != F.col("kept")["c"]) | (F.col("place") != F.col("kept")["d"]))
    places = gone.groupBy("row").agg(F.array_sort(F.collect_list("place")).alias("places"))
    return hashes.select("row", "key", "n_lines"), staged(places, "gone")


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_lines, n_removed and removed (the places of removed lines, from 0) of each document."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), key, text)
    every, gone = removed_lines(rows, key, text)
    return every.join(gone, "row", "left").select(
        F.col("key").alias(key), F.col("n_lines").cast("long"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("places", F.array().cast("array<int>")).alias("removed"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` without the removed lines; documents left without a line with a word are dropped.  ``length`` follows the text."""
    row = free_name(docs, "line_row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "line-documents")
    _, gone = removed_lines(rows.select(F.col(row).alias("row"), key, text), key, text)
    places = free_name(rows, "places")
    gone = gone.select(F.col("row").alias(row), F.col("places").alias(places))
    joined = rows.join(gone.hint("merge"), row, "left")  # both grow with the corpus: a shuffle at every size
    lines = F.split(F.col(text), "\n", -1)
    left = F.filter(F.transform(lines, lambda line, i: F.when(~F.array_contains(places, i), line)), lambda line: line.isNotNull())
    some = F.col(places).isNotNull()
    joined = joined.withColumn(text, F.when(some, F.array_join(left, "\n")).otherwise(F.col(text)))
    if length in docs.columns:
        joined = joined.withColumn(length, F.when(some, F.length(F.col(text))).otherwise(F.col(length)).cast(docs.schema[length].dataType))
    return joined.where(~some | F.col(text).rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)
