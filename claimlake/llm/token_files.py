"""Token files: frequency-ranked ids in a byte-aligned variable-length code.

A folder of token files holds three Parquet tables.

* ``ranks``: token id and rank; the most frequent id of the corpus has rank 0.
* ``frames``: one row per document in file order, with its place and two streams.
  ``data`` holds each rank in as few bytes as it needs (1 to 4, little-endian);
  ``control`` holds two bits per rank, its number of bytes less one, four ranks to a
  control byte from the lowest bits up.
* ``files``: for each file the number of ids in all files before it.

Files ascend by the document's key and so do the documents within them (nulls
first; equal keys by number of ids and their checksum).  Spark's commit protocol
writes them, so a lost executor leaves no half file.

Reading decodes whole batches: a table gives the byte lengths for every control
byte, their running sum the place of every rank, and four gathers its bytes.

Ids are kept once in the shared folder between counting and ranking, so texts are
tokenised once.  The rank table and the sums per file go through the driver: the
vocabulary bounds the first, the number of files the second.

Defined cases: a null or empty text holds the end id alone; a null key comes first
and stays null; repeated rows are written each for itself; an empty table gives
empty tables; other columns are not read; a very long text is one frame.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlake.llm.common import WordTable, shared_folder, staged, tune, worker_memory
from claimlake.llm.pack import WordEncoder

FILE_IDS = 16_000_000   # ids of a file, about

GATHER = 8 << 20        # bytes of text that are split and looked up together
WORDS_HELD = 500_000    # words whose ids a worker remembers; it forgets all when it meets more

#: Byte lengths of the four ranks of each control byte.
LENGTHS = np.array([[(byte >> 2 * i & 3) + 1 for i in range(4)] for byte in range(256)], np.uint8)


def encode_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(control, control_ends, data, data_ends) of the ranks of many documents, ``counts`` of each."""
    ranks, ends = ranks.astype("<u4"), np.cumsum(counts)
    code = (ranks >= 1 << 8).astype(np.uint8)
    code += ranks >= 1 << 16
    code += ranks >= 1 << 24
    groups = -(-counts // 4)
    slots = np.zeros(4 * int(groups.sum()), np.uint8)
    slots[np.arange(len(ranks)) + np.repeat(4 * (np.cumsum(groups) - groups) - (ends - counts), counts)] = code
    slots = slots.reshape(-1, 4)
    control = slots[:, 0] | slots[:, 1] << 2 | slots[:, 2] << 4 | slots[:, 3] << 6
    used = np.arange(int(code.max(initial=0)) + 1, dtype=np.uint8) <= code[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[:, :used.shape[1]][used]
    sizes = np.concatenate([[0], np.cumsum(code, dtype=np.int64)])
    return control, np.cumsum(groups), data, sizes[ends] + ends


def decode_ranks(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ranks of many documents, one after the other, from their joined streams."""
    slots = -(-counts // 4) * 4
    keep = np.ones(int(slots.sum()), bool)
    ends = np.cumsum(slots)
    for pad in range(1, 4):  # the last control byte of a document may have empty slots
        keep[ends[(slots - counts) >= pad] - pad] = False
    size = LENGTHS[control].reshape(-1)[keep]
    at = np.cumsum(size, dtype=np.int64) - size
    ranks = data[at].astype(np.uint32)
    for byte in range(1, int(size.max(initial=1))):
        longer = np.flatnonzero(size > byte)
        ranks[longer] |= data[at[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


def _joined(column: pa.Array) -> np.ndarray:
    """The bytes of a binary column's values, one after the other."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(column) else np.zeros(0, np.uint8)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column that cuts ``data`` at ``ends`` (in bytes)."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``GATHER`` bytes: words that documents share are then looked up once."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GATHER:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def token_ids(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """key, n_tokens, ids_crc32, ids (unsigned 16- or 32-bit, by the vocabulary's size) of each document."""
    tune(docs.sparkSession)
    narrow = _width(tokenizer_path)
    out = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_memory(f"files {tokenizer_path}", lambda: _word_table(tokenizer_path))
        for batch in _gathered(batches):
            split = pc.ascii_split_whitespace(pc.fill_null(batch.column(1), ""))  # empty pieces have no ids
            words = split.flatten().dictionary_encode()
            numbers = table.look_up(words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())
            numbers = numbers[words.indices.to_numpy()]
            word_ends = np.concatenate([[0], np.cumsum(table.count[numbers], dtype=np.int64)])
            stops = word_ends[split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]]
            ends = stops + np.arange(1, len(stops) + 1)
            ids = np.full(len(stops) + int(word_ends[-1]), end_id, "<u4")
            inner = np.ones(len(ids), bool)
            inner[ends - 1] = False
            ids[inner] = table.gather(numbers)
            starts, whole = np.concatenate([[0], ends[:-1]]), memoryview(ids).cast("B")
            sums = [zlib.crc32(whole[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends - starts), pa.array(sums, pa.int64()),
                 _binary(ids.astype(narrow).view(np.uint8), ends * np.dtype(narrow).itemsize)], names=out.names)
        pa.default_memory_pool().release_unused()

    return docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("text")).mapInArrow(encode, out)


def _word_table(tokenizer_path: str) -> WordTable:
    encoder = WordEncoder(tokenizer_path)
    encoder.LIMIT = WORDS_HELD // 4  # parts of words, each kept as a list
    return WordTable(encoder, WORDS_HELD)


def _width(tokenizer_path: str) -> str:
    return "<u2" if vocabulary_size(tokenizer_path) <= 1 << 16 else "<u4"


def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path).get_vocab_size()


def id_ranks(tokens: DataFrame, size: int) -> DataFrame:
    """id, rank: ids by falling count over all documents, then by id; ids that never occur come last."""
    narrow = "<u2" if size <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_joined(batch.column(0)).view(narrow), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    spark = tokens.sparkSession
    counted = tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = np.array([(r["id"], r["n"]) for r in counted.collect()], np.int64).reshape(-1, 2)  # at most the vocabulary
    total = np.zeros(size, np.int64)
    total[found[:, 0]] = found[:, 1]
    order = np.lexsort((np.arange(size), -total))
    return spark.createDataFrame(pd.DataFrame({"id": order, "rank": np.arange(size)}), "id long, rank long")


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, key: str = "doc_id", text: str = "text",
                      end_id: int = 2, file_ids: int = FILE_IDS) -> str:
    """Encode ``docs`` and write their token files to the folder ``path``."""
    tokens = staged(token_ids(docs, tokenizer_path, key, text, end_id), "tokens")
    size = max(vocabulary_size(tokenizer_path), end_id + 1)
    narrow = _width(tokenizer_path)
    ranks = id_ranks(tokens, size)
    ranks.coalesce(1).write.parquet(f"{path}/ranks")
    order = ranks.orderBy("rank").toPandas()
    rank_of = np.zeros(size, np.uint32)
    rank_of[order["id"].to_numpy()] = order["rank"].to_numpy()
    out = T.StructType([docs.schema[key], *T.StructType.fromDDL(
        "file int, place long, start_in_file long, n_tokens long, control binary, data binary").fields])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, place, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.column(1).to_numpy()
            control, control_ends, data, data_ends = encode_ranks(rank_of[_joined(batch.column(2)).view(narrow)], n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), file, np.int32)), pa.array(place + np.arange(len(n))),
                 pa.array(start + np.cumsum(n) - n), batch.column(1), _binary(control, control_ends), _binary(data, data_ends)],
                names=out.names)
            place, start = place + len(n), start + int(n.sum())

    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    spark = docs.sparkSession
    files = max(1, math.ceil(total / file_ids), min(spark.sparkContext.defaultParallelism, math.ceil(total / 100_000)))
    order = [F.col(key).asc_nulls_first(), F.col("n_tokens"), F.col("ids_crc32")]
    frames = tokens.repartitionByRange(files, *order).sortWithinPartitions(*order) \
        .select(key, "n_tokens", "ids").mapInArrow(code, out)
    frames.write.option("compression", "zstd").parquet(f"{path}/frames")
    before, rows = 0, []
    for r in spark.read.parquet(f"{path}/frames").groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect():
        rows.append((r["file"], before, r["n"]))  # one row per file
        before += r["n"]
    spark.createDataFrame(rows, "file int, start long, n_tokens long").coalesce(1).write.parquet(f"{path}/files")
    return path


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens, ids (little-endian unsigned 32-bit) of each document in the folder."""
    tune(spark)
    order = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()  # at most the vocabulary
    id_of = order["id"].to_numpy().astype("<u4")
    frames = spark.read.parquet(f"{path}/frames")
    out = T.StructType([frames.schema[key], *T.StructType.fromDDL(
        "file int, start_in_file long, n_tokens long, ids binary").fields])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(3).to_numpy()
            ids = id_of[decode_ranks(_joined(batch.column(4)), _joined(batch.column(5)), n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], _binary(ids.view(np.uint8), 4 * np.cumsum(n))], names=out.names)

    read = frames.select(key, "file", "start_in_file", "n_tokens", "control", "data").mapInArrow(decode, out)
    starts = spark.read.parquet(f"{path}/files").select("file", F.col("start").alias("file_start"))
    return read.join(starts, "file").select(
        key, (F.col("file_start") + F.col("start_in_file")).alias("start"),
        "n_tokens", "ids")


def round_trip(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back."""
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/llm-token-files-{uuid.uuid4().hex}"
    return read_token_files(spark, write_token_files(docs, tokenizer_path, path, **options))
