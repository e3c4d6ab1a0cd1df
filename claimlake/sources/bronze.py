"""Bronze scans: the four daily CSV feeds.

* claims / exposure: declared all-string schema, header skipped, columns
  bound by position (a malformed value survives as text for the rules);
* payments / expenses: raw text lines (the loads parse them strictly), after
  a header contract check of the file's first line.

File naming: ``<root>/<prefix>/<dataset>_<YYYY-MM-DD>.csv``.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import spread
from ..schemas import CLAIM_EVENT_FIELDS, EXPOSURE_FEED_FIELDS, POLICY_CHANGE_FIELDS, LedgerContract, all_strings

FEEDS = {
    "claims_events": ("claims-events", "claim_events"),
    "daily_exposure": ("daily-exposure", "daily_exposure"),
    "claim_payments": ("claim-payments", "claim_payments"),
    "expense_transactions": ("expense-transactions", "expense_transactions"),
    "policy_changes": ("policy-changes", "policy_changes"),
}


def feed_path(root: str, dataset: str, day: str) -> str:
    """All files of the feed for one day: ``stem_DAY.csv`` and ``stem_ANYTHING_DAY.csv``."""
    prefix, stem = FEEDS[dataset]
    return f"{root.rstrip('/')}/{prefix}/{stem}{{_,_*_}}{day}.csv"


def _lineage(df: DataFrame, day: str) -> DataFrame:
    return df.withColumn("source_file", F.col("_metadata.file_path")).withColumn(
        "load_date", F.lit(day).cast("date"))


MALFORMED = "malformed_record"


def read_whole_csv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """``fields`` as text, ``source_file`` and ``malformed_record``: the raw line of a row with too few
    or too many fields (its known fields are kept), else NULL.  Every file's header line is skipped."""
    schema = all_strings([*fields, MALFORMED])
    rows = spark.read.option("header", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED) \
        .schema(schema).csv(path)
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, header) of every file under ``path`` in one scan, a byte-order mark removed."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("n"))  # ascends within a file's block
    return lines.where("start = 0").groupBy("source_file").agg(
        F.regexp_replace(F.min_by("value", "n"), "^\\x{FEFF}", "").alias("header"))


def header_contract(spark: SparkSession, path: str, contracts: dict[str, list[str]]) -> DataFrame:
    """(source_file, header, contract): the name of the contract whose fields the header gives in order, else NULL."""
    parsed = F.transform(F.split("header", ","), lambda c: F.regexp_replace(c, '^"(.*)"$', "$1"))
    name = F.coalesce(*[F.when(parsed == F.array(*map(F.lit, fields)), F.lit(name)) for name, fields in contracts.items()])
    return first_lines(spark, path).select("source_file", "header", name.alias("contract"))


def read_declared_csv(spark: SparkSession, path: str, fields: list[str], day: str) -> DataFrame:
    """Header row skipped; every column text; short rows padded with NULL."""
    raw = (
        spark.read.option("header", "true").option("mode", "PERMISSIVE")
        .schema(all_strings(fields)).csv(path)
    )
    return spread(_lineage(raw, day).select(*fields, "source_file", "load_date"))


def read_claims(spark: SparkSession, root: str, day: str) -> DataFrame:
    return read_declared_csv(spark, feed_path(root, "claims_events", day), CLAIM_EVENT_FIELDS, day)


def read_exposure(spark: SparkSession, root: str, day: str) -> DataFrame:
    return read_declared_csv(spark, feed_path(root, "daily_exposure", day), EXPOSURE_FEED_FIELDS, day)


def read_policy_changes(spark: SparkSession, root: str, day: str) -> DataFrame:
    return read_declared_csv(spark, feed_path(root, "policy_changes", day), POLICY_CHANGE_FIELDS, day)


def header_matches(line: str, fields: list[str]) -> bool:
    return next(csv.reader([line]), []) == fields


def read_ledger_lines(spark: SparkSession, root: str, contract: LedgerContract, day: str,
                      allowed: list[LedgerContract] | None = None) -> tuple[DataFrame, LedgerContract, str]:
    """Check the header before anything is written, then scan raw lines.

    With ``allowed`` (schema evolution) the header selects the contract;
    an undeclared header fails the load."""
    text = spark.read.text(feed_path(root, contract.dataset, day))
    # a day has a few files; all must have the header of one contract
    headers = {r["header"] for r in first_lines(spark, feed_path(root, contract.dataset, day)).select("header").distinct().collect()} or {""}
    chosen = [candidate for candidate in (allowed or [contract]) if all(header_matches(h, candidate.fields) for h in headers)]
    if not chosen:
        raise ValueError("Bronze CSV header/order does not match expected schema")
    lines = spread(_lineage(text, day).select("value", "source_file", "load_date"))
    return lines.where(~F.regexp_replace("value", "^\\x{FEFF}", "").isin(*headers)), chosen[0], min(headers)
