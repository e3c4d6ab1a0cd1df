"""The registered queries of the training-data operators.

Each applies its operator with production parameters to its whole table and
derives the digest columns from the operator's output.
"""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import (bpe, conversation_repair, hard_negatives, line_dedup, lm_score, pack, pii, quality, secret_scan, shard,
                           simhash, token_files, topk)
from claimlake.llm.common import table, vocabulary

def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.scored(docs).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, max_bits=3).select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("long")
    every = F.array_sort(F.concat("base", "added"), lambda a, b: F.when(
        (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"])), -1).otherwise(
        F.when((a["start"] == b["start"]) & (a["kind"] == b["kind"]), 0).otherwise(1)))
    return pii.found_spans(docs).select(
        "doc_id", count("email").alias("n_email"), count("ip").alias("n_ip"), count("card").alias("n_card"),
        count("phone").alias("n_phone"), F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(every).alias("spans"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard.sharded(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack.pack_documents(docs, vocabulary("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encoded(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_sha256(F.col("ids")).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("ids"), ranks), 256).alias("decoded_sha256"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = secret_scan.scanned(docs, owner="source", repository="doc_id")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind_no"] < len(secret_scan.BASE_KINDS))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=10).select("query_id", "rank", "vec_id", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.fertility(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "quality.*")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_report(docs).select(
        "doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.repaired(turns, present=F.col("present")).drop("n")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    read = token_files.round_trip(docs, vocabulary("word_bpe_49k.json"), end_id=2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"op1_lm_score": op1_lm_score, "op2_simhash_near_dedup": op2_simhash_near_dedup,
           "op3_personal_data": op3_personal_data,
           "op4_sharding": op4_sharding, "op5_best_fit_packing": op5_best_fit_packing,
           "op6_byte_bpe": op6_byte_bpe, "op7_secret_scan": op7_secret_scan, "op8_exact_top_k": op8_exact_top_k,
           "op9_quality_rules": op9_quality_rules, "op10_line_dedup": op10_line_dedup,
           "op11_conversation_repair": op11_conversation_repair, "op12_token_files": op12_token_files,
           "op13_hard_negatives": op13_hard_negatives, "pipeline": pipeline}
