"""File-arrival ingestion of the Bronze feeds with Structured Streaming.

A file-source stream watches a feed's landing folder and tells which days have
new files.  For each of these days the batch load runs over *all* of the day's
files and replaces the day's Silver partitions, so the result does not depend on
which files share a micro-batch, and stream and batch give the same partitions:
``max_files`` bounds the size of a batch and nothing else.

``trigger(availableNow=True)`` processes everything that has landed and stops,
which is how a scheduler would run it; the checkpoint records which files were
seen, and a failed batch is replayed into the same partitions (overwrite, hence
idempotent).  It lives in the shared folder named by ``spark.checkpoint.dir``.

Files without a day in their names belong to no partition: they are logged and
left alone, and do not hold up the feed.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import jobs
from ..schemas import LedgerContract
from ..session import configure, ensure_checkpoint_dir
from ..sources import bronze

_DAY_IN_NAME = r"_([0-9]{4}-[0-9]{2}-[0-9]{2})\.csv$"
_LOG = logging.getLogger(__name__)


def arrivals(spark: SparkSession, bronze_root: str, dataset: str, max_files: int = 32) -> DataFrame:
    """One row per line of newly landed files: its file and the day in the file's name ('' if none)."""
    prefix, stem = bronze.FEEDS[dataset]
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).option("pathGlobFilter", f"{stem}_*.csv") \
        .text(f"{bronze_root.rstrip('/')}/{prefix}")
    path = F.col("_metadata.file_path")
    return lines.select(path.alias("source_file"), F.regexp_extract(path, _DAY_IN_NAME, 1).alias("day"))


def silver_batch_writer(bronze_root: str, silver_root: str, dataset: str,
                        payments: list[LedgerContract] | None = None, database: str | None = None):
    """foreachBatch function: the batch load of every day that has new files."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        # at most maxFilesPerTrigger rows
        files = batch.distinct().collect()
        for r in files:
            if not r["day"]:
                _LOG.warning("no day in the name of %s: not loaded", r["source_file"])
        for day in sorted({r["day"] for r in files if r["day"]}):
            jobs.load_feed(batch.sparkSession, bronze_root, silver_root, dataset, day, payments, database)
    return write


def start_silver_stream(spark: SparkSession, bronze_root: str, silver_root: str, dataset: str,
                        checkpoint: str | None = None, available_now: bool = True, max_files: int = 32,
                        payments: list[LedgerContract] | None = None, database: str | None = None) -> StreamingQuery:
    configure(spark)
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/bronze_to_silver/{dataset}"
    writer = (arrivals(spark, bronze_root, dataset, max_files).writeStream
              .foreachBatch(silver_batch_writer(bronze_root, silver_root, dataset, payments, database))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
