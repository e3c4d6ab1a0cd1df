"""Writing Silver partitions and publishing Gold generations.

Silver (K1, K2): one directory per load date, replaced as a whole on rerun
(also when the new result is empty, so a rerun never leaves stale rows).

Gold (K3-K5): every run writes an immutable generation
``_versions/<table>/as_of_date=D/run_id=R/`` (error if it exists), then a
manifest ``_manifests/as_of_date=D/run_id=R/`` naming the generation of
every table.  The manifest is written last and is the readers' barrier:
``read_gold`` resolves a table for one valuation date through the complete
manifest of the highest generation, so a half-written run is never visible
and a run that started earlier never replaces a newer one.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import generations

# Tables whose size does not grow with the data are written as one file.
SINGLE_FILE_TABLES = {"portfolio_performance", "expense_summary", "ibnr_bf_monthly"}


# ---------------------------------------------------------------------------
# Silver
# ---------------------------------------------------------------------------

def partition_path(root: str, dataset: str, day: str, quarantine: bool = False) -> str:
    base = f"{root.rstrip('/')}/quarantine/{dataset}" if quarantine else f"{root.rstrip('/')}/{dataset}"
    return f"{base}/load_date={day}"


def write_partition(df: DataFrame, root: str, dataset: str, day: str, quarantine: bool = False) -> str:
    """Replace exactly one load_date directory (load_date is the folder, not a column)."""
    path = partition_path(root, dataset, day, quarantine)
    df.drop("load_date").write.mode("overwrite").parquet(path)
    return path


def write_partitions(df: DataFrame, root: str, dataset: str, days: list[str], quarantine: bool = False) -> None:
    """Multi-day write (backfill): dynamic overwrite of the days present in
    ``df``, plus an explicit empty partition for every day without rows."""
    base = f"{root.rstrip('/')}/quarantine/{dataset}" if quarantine else f"{root.rstrip('/')}/{dataset}"
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_date").parquet(base))
    # Bounded by the number of days processed.
    present = {r["load_date"].isoformat() for r in df.select("load_date").distinct().collect()}
    empty = df.drop("load_date").limit(0)
    for day in days:
        if day not in present:
            empty.write.mode("overwrite").parquet(f"{base}/load_date={day}")


def check_load_balance(metrics: DataFrame) -> list[dict]:
    """input = valid + quarantine + duplicates collapsed, for every load date
    (metrics has one row per load date)."""
    rows = [r.asDict() for r in metrics.collect()]
    for r in rows:
        if r["input_rows"] != r["valid_rows"] + r["quarantine_rows"] + r["duplicate_rows_collapsed"]:
            raise AssertionError(f"load balance identity violated: {r}")
    return rows


# ---------------------------------------------------------------------------
# Gold
# ---------------------------------------------------------------------------

def new_run_id() -> str:
    return uuid.uuid4().hex


def generation_path(root: str, table: str, as_of: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/_versions/{table}/as_of_date={as_of}/run_id={run_id}"


def manifest_root(root: str, as_of: str) -> str:
    return f"{root.rstrip('/')}/_manifests/as_of_date={as_of}"


def contract_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/_contracts/{table}"


def unless_absent(read):
    """What ``read()`` gives; None if its path does not exist.  Every other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _schema_json(df: DataFrame) -> str:
    return json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema.fields])


def check_contract(spark: SparkSession, root: str, table: str, df: DataFrame) -> None:
    """A table's columns are fixed at first publication; a different schema
    needs an explicit migration instead of silently changing readers."""
    path = contract_path(root, table)
    wanted = _schema_json(df)
    stored = unless_absent(lambda: spark.read.text(path).collect()) or []  # none: first publication
    if not stored:
        spark.createDataFrame([(wanted,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    if stored[0]["value"] != wanted:
        raise ValueError(f"Gold schema mismatch for {table}; explicit schema migration required")


def write_generation(df: DataFrame, root: str, table: str, as_of: str, run_id: str) -> str:
    path = generation_path(root, table, as_of, run_id)
    out = df.coalesce(1) if table in SINGLE_FILE_TABLES else df
    out.write.mode("errorifexists").parquet(path)
    return path


MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("period_start", T.StringType()),
    T.StructField("as_of_date", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("rows", T.MapType(T.StringType(), T.LongType())),
    T.StructField("locations", T.MapType(T.StringType(), T.StringType())),
    T.StructField("generation", T.LongType()),
])


def claim_generation(spark: SparkSession, root: str, as_of: str) -> int:
    """A publisher's number for a valuation date, to be taken before its inputs are read."""
    return generations.claim(spark, manifest_root(root, as_of))


def write_manifest(spark: SparkSession, root: str, start: str, as_of: str, run_id: str,
                   rows: dict[str, int], locations: dict[str, str], generation: int | None = None) -> dict:
    manifest = {
        "generation": generation or claim_generation(spark, root, as_of),
        "run_id": run_id, "period_start": start, "as_of_date": as_of,
        "published_at": datetime.now(timezone.utc).isoformat(),
        "rows": rows, "locations": locations,
    }
    (spark.createDataFrame([manifest], MANIFEST_SCHEMA).coalesce(1)
     .write.mode("errorifexists").json(f"{manifest_root(root, as_of)}/run_id={run_id}"))
    return manifest


def _newest() -> list[Column]:
    """The highest generation first; the rest orders manifests written before there were generations."""
    return [F.desc_nulls_last("generation"), F.desc("published_at"), F.desc("run_id")]


def latest_manifest(spark: SparkSession, root: str, as_of: str) -> dict:
    path = manifest_root(root, as_of)
    manifests = unless_absent(lambda: spark.read.schema(MANIFEST_SCHEMA).json(path))
    top = manifests and manifests.orderBy(*_newest()).limit(1).collect()
    if not top:
        raise ValueError(f"No Gold publication for as_of_date={as_of}")
    return top[0].asDict(recursive=True)


def manifest_before(spark: SparkSession, root: str, day: str) -> dict | None:
    """The newest manifest of the last valuation date before ``day``; None if there is none."""
    manifests = unless_absent(lambda: spark.read.schema(MANIFEST_SCHEMA).json(f"{root.rstrip('/')}/_manifests/*/*"))
    top = manifests and manifests.where(F.col("as_of_date") < day).orderBy(
        F.col("as_of_date").desc(), *_newest()).limit(1).collect()
    return top[0].asDict(recursive=True) if top else None


def read_gold(spark: SparkSession, root: str, table: str, as_of: str) -> DataFrame:
    """One valuation snapshot of one Gold table, via the manifest."""
    manifest = latest_manifest(spark, root, as_of)
    return spark.read.parquet(manifest["locations"][table]).withColumn("as_of_date", F.lit(as_of))
