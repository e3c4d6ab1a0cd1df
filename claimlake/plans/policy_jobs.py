"""Policy changes from file to effective-dated history, one load date at a time.

The history of a load date is a generation of its own, published behind a manifest: it
splices the day's valid changes into the last history before that date.  Running a date
again starts from the same earlier history, so it publishes the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import iso_day
from ..operators import policy_history, policy_silver
from ..schemas import POLICY_CHANGE_FIELDS
from ..session import configure
from ..sources import bronze
from . import publish

HISTORY = "policy_history"


def load_policy_changes(spark: SparkSession, bronze_root: str, silver_root: str, day: str, policies: DataFrame) -> dict:
    """Silver partition, quarantine and history of ``day``; ``policies`` lists the policies that exist."""
    configure(spark)
    iso_day(day)
    root = f"{silver_root.rstrip('/')}/{HISTORY}"
    before = publish.manifest_before(spark, root, day)
    earlier = spark.read.parquet(before["locations"][HISTORY]) if before else None
    result = policy_silver.silver_policy_changes(bronze.read_policy_changes(spark, bronze_root, day), policies, earlier)
    publish.write_partition(result.valid, silver_root, "policy_changes", day)
    publish.write_partition(result.quarantine, silver_root, "policy_changes", day, quarantine=True)
    valid = spark.read.parquet(publish.partition_path(silver_root, "policy_changes", day)).select(POLICY_CHANGE_FIELDS)
    history = policy_history.scd2(valid) if earlier is None else policy_history.splice(earlier, valid)
    run = publish.new_run_id()
    publish.check_contract(spark, root, HISTORY, history)
    place = publish.write_generation(history, root, HISTORY, day, run)
    return publish.write_manifest(spark, root, day, day, run, {HISTORY: spark.read.parquet(place).count()}, {HISTORY: place})


def read_policy_history(spark: SparkSession, silver_root: str, day: str) -> DataFrame:
    """The history published for ``day``."""
    manifest = publish.latest_manifest(spark, f"{silver_root.rstrip('/')}/{HISTORY}", day)
    return spark.read.parquet(manifest["locations"][HISTORY]).withColumn("as_of_date", F.lit(day).cast("date"))
