"""Session construction and cluster-facing settings.

Every job runs with a UTC session clock, ANSI SQL semantics (overflow fails
instead of silently producing null money) and snappy Parquet.  Shuffle
parallelism is left to AQE: partitions are coalesced at runtime and skewed
join partitions are split, which is what keeps one hot claim or policy from
landing in a single task on a large cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .functions.plan import INPUT_PARTITIONS

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A Silver rerun replaces exactly one load_date directory, even with an
    # empty result; dynamic partition overwrite would leave stale rows then.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings every job relies on (idempotent)."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "claimlake", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(INPUT_PARTITIONS, str(shuffle_partitions))  # the benchmark tables are single row groups
        .config("spark.driver.memory", os.environ.get("CLAIMLAKE_DRIVER_MEMORY", "8g"))
    )
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master without one gets a scratch folder; on a cluster a missing setting is
    an error, since a machine's own folder is lost with the machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="claimlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once under the shared folder and read back: what follows starts from files."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """As ``staged``, in ``parts`` buckets of ``key``: groupings and joins by it find their rows together.

    The table's name is given up at once; the files stay, and what was read knows their buckets."""
    spark, table = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{table}"
    df.repartition(parts, key).write.format("parquet").option("path", path).bucketBy(parts, key).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows
