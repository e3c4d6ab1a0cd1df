"""One commit for a load date: valid rows and quarantine become visible together (K1, K2, K8).

First both frames are written to folders of their own generation; then one manifest names
them.  Readers resolve every load date through the manifest of its highest generation, so a
load that fails between the two writes leaves the old day as it was, and a rerun replaces
both parts at once, with empty results too.

The row counts of a load are measured by its own writes (``Observation``): no further action
runs, and the identity input = valid + quarantine + duplicates collapsed is checked before
the manifest is written.

    <root>/_days/<dataset>/load_date=D/generation=N/kind=valid|quarantine/
    <root>/_day_manifests/<dataset>/load_date=D/generation=N/
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import iso_day, window
from ..operators.silver import SilverResult
from . import generations, publish

MANIFEST = ("dataset string, load_date date, generation long, input_rows long, valid_rows long, quarantine_rows long, "
            "duplicate_rows_collapsed long, valid string, quarantine string")
METRICS = ["dataset", "load_date", "input_rows", "valid_rows", "quarantine_rows", "duplicate_rows_collapsed"]


def _manifests(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/_day_manifests/{dataset}"


def write_generation(root: str, dataset: str, day: str, generation: int, result: SilverResult) -> dict:
    """Both parts of a load, and what their writes measured."""
    measured, places = {"duplicate_rows_collapsed": 0}, {}
    for kind in ("valid", "quarantine"):
        rows = Observation()
        places[kind] = f"{root.rstrip('/')}/_days/{dataset}/load_date={day}/generation={generation:08d}/kind={kind}"
        getattr(result, kind).drop("load_date").observe(rows, F.count(F.lit(1)).alias("rows")) \
            .write.mode("errorifexists").parquet(places[kind])
        measured[f"{kind}_rows"] = rows.get["rows"]
        if kind == "valid":
            for observation in result.observations:
                measured.update(observation.get)
    measured.pop("invalid_rows", None)
    return {**measured, **places}


def commit(spark: SparkSession, root: str, dataset: str, day: str, generation: int, written: dict) -> dict:
    """Publish the parts under ``generation``; the load's identity must hold."""
    if written["input_rows"] != written["valid_rows"] + written["quarantine_rows"] + written["duplicate_rows_collapsed"]:
        raise AssertionError(f"load balance identity violated: {written}")
    manifest = {"dataset": dataset, "load_date": iso_day(day), "generation": generation, **written}
    spark.createDataFrame([manifest], MANIFEST).coalesce(1).write.mode("errorifexists").json(
        f"{_manifests(root, dataset)}/load_date={day}/generation={generation:08d}")
    return manifest


def publish_day(spark: SparkSession, root: str, dataset: str, day: str, load) -> dict:
    """``load()`` gives the day's SilverResult; the generation is claimed before it reads."""
    iso_day(day)
    generation = generations.claim(spark, f"{_manifests(root, dataset)}/load_date={day}")
    return commit(spark, root, dataset, day, generation, write_generation(root, dataset, day, generation, load()))


def committed_days(spark: SparkSession, root: str, dataset: str, start: str, end: str) -> DataFrame:
    """The manifest in force of every committed load date in [start, end]."""
    window(start, end)
    found = publish.unless_absent(lambda: spark.read.schema(MANIFEST).json(f"{_manifests(root, dataset)}/*/*"))
    if found is None:
        found = spark.createDataFrame([], MANIFEST)
    inside = found.where(F.col("load_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return inside.groupBy("load_date").agg(F.max_by(F.struct(*inside.columns), "generation").alias("m")).select("m.*")


def load_metrics(spark: SparkSession, root: str, dataset: str, start: str, end: str) -> DataFrame:
    """What the loads in force measured, one row per load date."""
    return committed_days(spark, root, dataset, start, end).select(*METRICS)


def read_days(spark: SparkSession, root: str, dataset: str, start: str, end: str, kind: str = "valid",
              complete: bool = True) -> DataFrame:
    """Rows of [start, end] with ``load_date``; every day must be committed unless ``complete`` is False."""
    first, last = window(start, end)
    # one row per day of the window
    places = {r["load_date"]: r[kind] for r in committed_days(spark, root, dataset, start, end).collect()}
    missing = (last - first).days + 1 - len(places)
    if (complete and missing) or not places:
        raise ValueError(f"{dataset}: {missing} load dates of {start}..{end} are not committed")
    rows = spark.read.option("basePath", f"{root.rstrip('/')}/_days/{dataset}").option("mergeSchema", "true").parquet(*places.values())
    return rows.drop("generation", "kind")
