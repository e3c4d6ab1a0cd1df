"""Byte-level BPE with the ranks of a public vocabulary, encoded and decoded.

Texts are split by the vocabulary's pattern.  The distinct words of the corpus are
counted, and the merges of the most frequent ones are folded once, by Spark
higher-order functions: a word is an array of bytes, and each step of the fold joins
the neighbours whose union has the lowest rank, until no union has one.  The ranks
are a literal in the plan, a table of small maps addressed by a checksum, since a
plain map is searched from its start.  The frequent words' ids are a dictionary of
at most ``FREQUENT`` words of at most ``LONG`` bytes, sent to every worker; all other
words are folded in place, once per distinct word of a document.  Decoding looks up
the bytes of every id and concatenates them.

The dictionary only saves work: every word gets the ids that the fold gives, however
rare.  Words over ``LONG`` bytes are merged from a heap, in n log n steps.

Defined cases: null and empty texts have no ids and decode to no bytes; repeated rows
are answered each for itself; an empty table gives an empty result; columns other than
the key and the text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import staged, tune

FREQUENT = 400_000      # words in the dictionary, at most
LONG = 64               # bytes of a word in the dictionary or the fold, at most
BUCKETS = 1 << 16       # maps of the literal rank table
NO_RANK = 2 ** 31 - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of maps from hex to rank, at the token's checksum."""
    maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in ranks.items():
        hexed = token.hex().upper()
        maps[zlib.crc32(hexed.encode()) % BUCKETS][hexed] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def piece_table(ranks: dict[bytes, int]) -> Column:
    """The hex bytes of each id, as a literal array."""
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex().upper()
    return F.split(F.lit(",".join(pieces)), ",")


def _rank(table: Column, hexed: Column) -> Column:
    at = F.crc32(hexed.cast("binary")) % BUCKETS
    return F.coalesce(F.try_element_at(F.get(table, at.cast("int")), hexed), F.lit(NO_RANK))


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def fold(hexed: Column, table: Column) -> Column:
    """The hex tokens of a word given as hex bytes: merges by lowest rank, leftmost first.

    The state holds the parts and the rank of each pair of neighbours; a merge asks for
    the ranks of the two pairs that it changes."""
    n_bytes = (F.length(hexed) / 2).cast("int")
    parts = F.transform(F.sequence(F.lit(1), n_bytes), lambda i: F.substring(hexed, i * 2 - 1, F.lit(2)))
    pairs = F.when(n_bytes < 2, F.array().cast("array<int>")).otherwise(F.transform(
        F.sequence(F.lit(1), n_bytes - 1), lambda i: _rank(table, F.substring(hexed, i * 2 - 1, F.lit(4)))))

    def merge(state: Column, at: Column, new: Column) -> Column:
        parts, ranks = state["parts"], state["ranks"]  # at: the first of the two parts, from 1
        changed = F.transform(
            F.filter(F.array(F.concat(F.get(parts, at - 2), new), F.concat(new, F.get(parts, at + 1))), lambda pair: pair.isNotNull()),
            lambda pair: _rank(table, pair))
        return F.struct(
            F.concat(F.slice(parts, 1, at - 1), F.array(new), F.slice(parts, at + 2, F.size(parts))).alias("parts"),
            F.concat(F.slice(ranks, 1, F.greatest(at - 2, F.lit(0))), changed, F.slice(ranks, at + 2, F.size(parts))).alias("ranks"))

    def step(state: Column, _: Column) -> Column:
        return _with(F.array_min(state["ranks"]), lambda least: F.when(least < NO_RANK, _with(
            F.array_position(state["ranks"], least).cast("int"), lambda at: _with(
                F.concat(F.get(state["parts"], at - 1), F.get(state["parts"], at)), lambda new: merge(state, at, new)))).otherwise(state))

    # one merge less than bytes at most
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n_bytes - 1, F.lit(1))),
                       F.struct(parts.alias("parts"), pairs.alias("ranks")), step, lambda state: state["parts"])


def token_ids(hexed: Column, table: Column) -> Column:
    """The ids of a word given as hex bytes.

    The table is bound to one variable for the whole expression: each mention of a literal
    would be a copy of its own in every plan that the driver keeps, and in its printed form."""
    return F.aggregate(F.array(table), F.array().cast("array<int>"), lambda _, bound: F.transform(
        fold(hexed, bound), lambda token: _rank(bound, token)))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> bytes:
    """The same merges from a heap, for long words."""
    parts: list[bytes | None] = [word[i:i + 1] for i in range(len(word))]
    after = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(word) - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i: int) -> None:
        j = after[i]
        if i >= 0 and j < len(word) and (r := ranks.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (r, i, parts[i], parts[j]))

    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= len(word) or parts[j] != right:
            continue  # one of the two has been merged since
        parts[i], parts[j], after[i] = left + right, None, after[j]
        if after[i] < len(word):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return np.array([ranks[p] for p in parts if p is not None], "<u4").tobytes()


def word_counts(texts: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    """(word, n): the distinct words of at most ``LONG`` bytes and their number, over all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = regex.compile(pattern).findall
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch["text"]:
                if t:
                    seen.update(find(t))
            if len(seen) > 300_000:
                yield _counted(seen)
                seen = Counter()
        yield _counted(seen)

    def _counted(seen: Counter) -> pd.DataFrame:
        words = [w for w in seen if len(w.encode()) <= LONG]
        return pd.DataFrame({"word": pd.Series(words, dtype=object), "n": pd.Series([seen[w] for w in words], dtype="int64")})

    return texts.select(F.col(text).alias("text")).mapInPandas(count, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The words above the lowest count level that leaves at most ``limit`` of them."""
    level = F.floor(F.log2(F.col("n")) * 8)
    held, least = 0, None
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect(), key=lambda r: -r["level"]):
        held += r["words"]
        if held > limit:
            break
        least = r["level"]
    return counts.where(level >= F.lit(least)) if least is not None else counts.limit(0)


def encoded(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ids (array of int)."""
    spark = tune(docs.sparkSession)
    ranks = read_ranks(ranks_path)
    table = rank_table(ranks)
    frequent = most_frequent(staged(word_counts(docs, pattern, text), "word-counts"), FREQUENT) \
        .select("word", token_ids(F.hex(F.col("word").cast("binary")), table).alias("ids"))
    # at most FREQUENT words of at most LONG bytes
    held = staged(frequent, "frequent").toArrow().combine_chunks()
    flat, ends = held["ids"].combine_chunks().flatten().to_numpy().astype("<i4").tobytes(), held["ids"].combine_chunks().offsets.to_pylist()
    known = spark.sparkContext.broadcast({w: flat[4 * a:4 * b] for w, a, b in zip(held["word"].to_pylist(), ends, ends[1:])})

    @F.pandas_udf("known array<int>, ends array<int>, rare array<string>, which array<int>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        find, get = regex.compile(pattern).findall, known.value.get
        for texts in batches:
            rows = []
            for t in texts:
                runs, run, rare, which = [], [], {}, []
                for word in find(t) if t else ():
                    ids = get(word)
                    if ids is None and len(word) > LONG // 4 and len(raw := word.encode()) > LONG:
                        ids = merge_long(raw, ranks)
                    if ids is None:
                        runs.append(b"".join(run))
                        run = []
                        which.append(rare.setdefault(word, len(rare)))
                    else:
                        run.append(ids)
                runs.append(b"".join(run))
                ends = np.cumsum([len(r) // 4 for r in runs]).astype(np.int32)
                rows.append((np.frombuffer(b"".join(runs), "<i4"), ends, [w.encode().hex().upper() for w in rare], which))
            yield pd.DataFrame(rows, columns=["known", "ends", "rare", "which"])

    found = docs.select(F.col(key), split(F.col(text)).alias("s")).select(key, "s.*")
    # a run of known ids, the ids of a rare word, ..., a last run of known ids
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("ends", i - 1))
    folded = F.transform("rare", lambda word: token_ids(word, table))
    spliced = _with(folded, lambda folded: F.flatten(F.transform("ends", lambda end, i: F.concat(
        F.slice("known", start(i) + 1, end - start(i)), F.coalesce(F.get(folded, F.get("which", i)), F.array().cast("array<int>"))))))
    # A generator ends the projection: what is made of the ids later does not fold again.
    return found.select(key, F.explode(F.array(F.when(F.size("which") == 0, F.col("known")).otherwise(spliced))).alias("ids"))


def decoded(ids: Column, ranks_path: str) -> Column:
    """The bytes of an array of ids."""
    pieces = piece_table(read_ranks(ranks_path))
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


def ids_sha256(ids: Column) -> Column:
    """The hash of ids as little-endian unsigned 32-bit numbers, in lowercase hex."""

    @F.pandas_udf("string")
    def digest(each: pd.Series) -> pd.Series:
        return pd.Series([hashlib.sha256(np.asarray(i, "<u4").tobytes()).hexdigest() for i in each])

    return digest(ids)
