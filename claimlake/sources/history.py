"""Silver history by load date: date spine, completeness check, scan.

A Gold or IBNR run needs every daily Silver partition in [start, end].  A
partition counts as present when its directory holds at least one Parquet
file -- an empty day is data (zero rows), a missing day is an error.
"""

from __future__ import annotations


from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_number, window
from ..schemas import SILVER_SCHEMAS


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day in [start, end] (``load_date``)."""
    window(start, end)
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))).alias("load_date"))


def window_folders(root: str, start: str, end: str) -> str:
    """A pattern for the partition folders of the months that the window touches: nothing else is listed."""
    first, last = window(start, end)
    months = range(month_number(first), month_number(last) + 1)
    return f"{root}/load_date={{{','.join(f'{m // 12:04d}-{m % 12 + 1:02d}' for m in months)}}}-*"


def available_dates(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    """load_date of every partition folder around the window that holds a Parquet file.

    Listing runs through Spark's file index (parallel for many folders);
    only the path column is read, never file contents."""
    try:
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(window_folders(root, start, end)).select("path")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "load_date date")
    day = F.regexp_extract("path", r"/load_date=([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1)
    return files.select(day.alias("d")).filter(F.col("d") != "").select(
        F.col("d").cast("date").alias("load_date")).distinct()


def days_without_rows(spark: SparkSession, df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """Calendar days of [start, end] on which ``df`` has no row (S6 spine minus
    the days present, U3).  The spine is bounded by the window length; the
    data side is reduced to its distinct days before the anti join."""
    present = df.select(F.col(date_col).cast("date").alias("load_date")).distinct()
    return date_spine(spark, start, end).join(present, "load_date", "left_anti")


def missing_dates(spark: SparkSession, root: str, start: str, end: str) -> DataFrame:
    return date_spine(spark, start, end).join(available_dates(spark, root, start, end), "load_date", "left_anti")


def require_complete(spark: SparkSession, root: str, dataset: str, start: str, end: str) -> None:
    # The result is bounded by the number of days in the window.
    missing = sorted(r["load_date"].isoformat() for r in missing_dates(spark, root, start, end).collect())
    if missing:
        raise ValueError(f"{dataset}: missing Silver Parquet partitions: {missing}. Run Bronze-to-Silver first.")


def silver_history(spark: SparkSession, silver_root: str, dataset: str, start: str, end: str,
                   check: bool = True) -> DataFrame:
    """The dataset's Silver rows for [start, end] with ``load_date`` as a
    column; partition pruning restricts the scan to the window.

    A known dataset is read by its declared schema: no file is opened to learn
    its columns, and days of every contract version come in one shape."""
    root = f"{silver_root.rstrip('/')}/{dataset}"
    if check:
        require_complete(spark, root, dataset, start, end)
    reader = spark.read.schema(SILVER_SCHEMAS[dataset]) if dataset in SILVER_SCHEMAS else spark.read
    df = reader.option("basePath", root).parquet(window_folders(root, start, end))
    return df.filter(F.col("load_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
