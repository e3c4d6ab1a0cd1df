"""Helpers that the training-data operators share.

* ``staged`` writes a frame once into the shared folder that the cluster names
  in ``spark.checkpoint.dir`` and reads it back: a lost executor never replays
  what lies before it.
* ``free_name`` finds a column name that the caller's frame does not use.
* ``connected_components`` is union-find as joins and minimum aggregates.
* ``WordTable`` is a bounded per-worker memory of what a tokenizer says about a word.
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import types
import uuid
from itertools import chain, islice

import numpy as np
import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch.  Documents may be very long, so batches are kept short.
BATCH_ROWS = 256

#: Edges that a task of the component search holds, on average.
EDGES_A_TASK = 50_000

_SCRATCH: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches short (a batch of documents must fit a Python worker) and send this
    package's functions to the workers by value: executors need no copy of the repository."""
    cloudpickle.register_pickle_by_value(sys.modules["claimlake"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a scratch folder only for a local master without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = tempfile.mkdtemp(prefix="llm-stage-")
    return _SCRATCH[app]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back (cuts the lineage, survives lost executors)."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that name (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


#: Where the public vocabularies lie; every operator that uses one takes its path as a parameter.
TOKENIZERS = os.environ.get("LLM_TOKENIZERS") or os.path.dirname(public_tokenizers.path("x"))


def vocabulary(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: bytes | None) -> list[bytes]:
    """The maximal runs outside ``\\x20\\x09-\\x0D`` (what ``bytes.split`` takes as white space)."""
    return text.split() if text else []


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for undirected edges ``(a, b)``; component is the smallest reachable node.

    Alternating large-star and small-star steps: every step hangs the neighbours
    of a node on their smallest neighbour, until each component is one star.  A
    step is a minimum aggregate (combined map-side) and a join on the node, whose
    hot side AQE can split; neighbour lists are never gathered.  Self loops are
    allowed (they keep a lone node in the result); no edges give no rows.
    """
    state = staged(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), name)
    n, seen = state.count(), None
    while n:
        # The edges shrink to a small part of their input's rows: few tasks, more with more edges.
        parts = max(8, math.ceil(n / EDGES_A_TASK))
        # large star: every larger neighbour of u hangs on the least of u and its neighbours
        both = state.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            state.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(parts), name)
        large = staged(
            both.join(least, "u").where((F.col("v") > F.col("u")) | (F.col("v") == F.col("m")))
            .select(F.greatest("u", "v").alias("hi"), F.col("m").alias("lo")).coalesce(parts), name)
        # small star: u and its smaller neighbours hang on the least of them
        root = staged(large.groupBy("hi").agg(F.min("lo").alias("m")).coalesce(parts), name)
        state = staged(
            large.join(root, "hi")
            .select(F.explode(F.array(
                F.struct(F.col("hi"), F.col("m").alias("lo")),
                F.struct(F.greatest("lo", "m").alias("hi"), F.col("m").alias("lo")))).alias("edge"))
            .select("edge.*").distinct().coalesce(parts), name)
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        n, seen = mark[0], mark
    return state.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))


class _Numbering(dict):
    """Gives each new word the next number."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


class WordTable:
    """A tokenizer's answers per distinct word, by number; forgotten when ``limit`` words are held.

    ``encode(list of words) -> list of token-id lists``; ids lie one after the other in one array."""

    def __init__(self, encode, limit: int = 1_000_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self):
        self.index = _Numbering()
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int32)
        self.used = 0

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """The number of each word; words not met before are encoded together."""
        if len(self.index) > self.limit:
            self.clear()
        n = len(self.index)
        numbers = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new = len(self.index) - n
        if new:
            coded = self.encode(list(islice(reversed(self.index), new))[::-1])
            sizes = np.fromiter(map(len, coded), np.int64, new)
            total = int(sizes.sum())
            self.flat = _grown(self.flat, self.used + total)
            self.start = _grown(self.start, n + new)
            self.count = _grown(self.count, n + new)
            self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(coded), np.int32, total)
            self.count[n:n + new] = sizes
            self.start[n:n + new] = self.used + np.cumsum(sizes) - sizes
            self.used += total
        return numbers

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        """The tokens of these words, one after the other."""
        sizes = self.count[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        at = np.repeat(self.start[numbers] - (ends - sizes), sizes)
        at += np.arange(len(at))
        return self.flat[at]


def worker_memory(key: str, make):
    """What ``make()`` gave this Python worker for ``key``; a worker serves many tasks and keeps the last one only."""
    memory = sys.modules.setdefault("llm_worker_memory", types.ModuleType("llm_worker_memory")).__dict__.setdefault("kept", {})
    if key not in memory:
        memory.clear()
        memory[key] = make()
    return memory[key]


def _grown(a: np.ndarray, need: int) -> np.ndarray:
    if need <= len(a):
        return a
    out = np.zeros(max(need, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out
