"""The corpus pipeline: quality rules, line dedup, near-duplicates, secrets, packing.

Each stage takes all that the stage before kept, written as Parquet and read again;
all but the last return the columns of ``documents``.

* quality: documents that the rules reject go; null and empty texts are rejected.
* lines: of alike lines in the corpus one stays; documents left without a word go.
* near_duplicates: one document of each SimHash component stays.
* secrets: values of live-looking secrets are replaced; widely copied examples stay.
* packing: token pieces with their places in sequences of 2048.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimlake.llm import line_dedup, pack, quality, secret_scan, simhash
from claimlake.llm.common import staged, table, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, vocabulary("piece_bpe_32k.model"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack.pack_documents(docs, vocabulary("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packing),
]

#: The stages need models, union-find and search; they are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
