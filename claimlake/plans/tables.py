"""Catalog registration with Spark SQL DDL (session catalog or a metastore).

* Silver (K7): one table per dataset at the dataset root, partitioned by
  ``load_date`` (string).  A successful load registers just its partition;
  reruns are no-ops; a partition already registered elsewhere is an error.
* Gold (K4): one table per output, partitioned by ``as_of_date``.  Columns,
  partition key and location are a contract: any drift needs an explicit
  migration.  Publishing points the valuation date's partition at the run's
  immutable generation (add, or re-point on rerun), after every file exists.
* Reports: the report functions run over the registered Gold tables, one
  ``as_of_date`` at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import reports


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _norm(path: str) -> str:
    p = path.rstrip("/")
    return p[len("file:"):] if p.startswith("file:") else p


def table_location(spark: SparkSession, fq: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {fq}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def partition_location(spark: SparkSession, fq: str, key: str, value: str) -> str | None:
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {fq} PARTITION ({_q(key)} = '{value}')").filter(
            "col_name = 'Location'").collect()
    except AnalysisException as error:
        if "PARTITION" in (error.getCondition() or "") and "NOT_FOUND" in error.getCondition():
            return None  # not registered
        raise
    return rows[0]["data_type"] if rows else None


def ensure_table(spark: SparkSession, database: str, table: str, schema: T.StructType,
                 partition_key: str, location: str, may_lack: bool = False) -> str:
    """Create the database/table if absent; otherwise enforce the contract.

    ``may_lack``: the data may lack columns of the table, which then read as null."""
    fq = f"{_q(database)}.{_q(table)}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_q(database)}")
    wanted = [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name != partition_key]
    if not spark.catalog.tableExists(f"{database}.{table}"):
        cols = ", ".join(f"{_q(n)} {t}" for n, t in wanted + [(partition_key, "string")])
        spark.sql(f"CREATE TABLE {fq} ({cols}) USING parquet PARTITIONED BY ({_q(partition_key)}) "
                  f"LOCATION '{location}'")
        return fq
    existing = spark.table(fq).schema
    have = [(f.name, f.dataType.simpleString()) for f in existing.fields if f.name != partition_key]
    keys = [c.name for c in spark.catalog.listColumns(f"{database}.{table}") if c.isPartition]
    same = set(wanted) <= set(have) if may_lack else have == wanted
    if not same or keys != [partition_key]:
        raise ValueError(f"schema mismatch for {database}.{table}; explicit schema migration required")
    if _norm(table_location(spark, fq)) != _norm(location):
        raise ValueError(f"Unexpected location for {database}.{table}")
    return fq


def ensure_silver_table(spark: SparkSession, database: str, dataset: str, silver_root: str, schema: T.StructType) -> str:
    return ensure_table(spark, database, dataset, schema, "load_date", f"{silver_root.rstrip('/')}/{dataset}", may_lack=True)


def add_columns(spark: SparkSession, database: str, table: str, schema: T.StructType) -> list[str]:
    """The explicit migration: add the nullable columns of ``schema`` that the table lacks."""
    have = set(spark.table(f"{_q(database)}.{_q(table)}").columns)
    new = [f for f in schema.fields if f.name not in have]
    if new:
        columns = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {_q(database)}.{_q(table)} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def register_silver_partition(spark: SparkSession, database: str, dataset: str, silver_root: str,
                              day: str, schema: T.StructType) -> str:
    fq = ensure_silver_table(spark, database, dataset, silver_root, schema)
    location = f"{silver_root.rstrip('/')}/{dataset}/load_date={day}"
    current = partition_location(spark, fq, "load_date", day)
    if current is None:
        spark.sql(f"ALTER TABLE {fq} ADD IF NOT EXISTS PARTITION (load_date = '{day}') LOCATION '{location}'")
    elif _norm(current) != _norm(location):
        raise ValueError(f"Existing partition for {dataset} points to a different location")
    return location


def register_gold(spark: SparkSession, database: str, gold_root: str, manifest: dict) -> None:
    """Point every table's as_of_date partition at the manifest's generation."""
    as_of = manifest["as_of_date"]
    plans = {}
    for table, location in manifest["locations"].items():
        schema = spark.read.parquet(location).schema
        plans[table] = (ensure_table(spark, database, table, schema, "as_of_date",
                                     f"{gold_root.rstrip('/')}/{table}"), location)
    for table, (fq, location) in plans.items():
        if partition_location(spark, fq, "as_of_date", as_of) is None:
            spark.sql(f"ALTER TABLE {fq} ADD PARTITION (as_of_date = '{as_of}') LOCATION '{location}'")
        else:
            spark.sql(f"ALTER TABLE {fq} PARTITION (as_of_date = '{as_of}') SET LOCATION '{location}'")


#: Report -> the Gold table it reads and its DataFrame function.
REPORTS = {
    "portfolio": ("portfolio_performance", reports.report_portfolio),
    "region_contribution": ("policy_performance", reports.report_region_contribution),
    "expense_mix": ("expense_summary", reports.report_expense_mix),
    "unreconciled_claims": ("claim_snapshot", reports.report_unreconciled_claims),
}


def report(spark: SparkSession, database: str, name: str, as_of: str) -> DataFrame:
    """A report over the registered tables, for one valuation date (one partition is read)."""
    table, rows = REPORTS[name]
    return rows(spark.table(f"{_q(database)}.{_q(table)}").where(F.col("as_of_date") == F.lit(as_of)))
