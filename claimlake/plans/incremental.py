"""Date-ordered Gold builds that merge one day into the state of the day before (C17).

A run writes the new state and the Gold tables as generations and then one manifest
that names them all, so state and tables of a date become visible together.  The next
date starts from that manifest.  ``seen`` is a list of files, one per date, that the
manifest carries on; no date rewrites another's.

Where the day before has no state for the same window start (a first run, or history
published by the full build), the state is built from the whole window once.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import window
from ..operators import gold, gold_state
from ..operators.checks import require_empty, violation_rows
from ..schemas import GOLD_TABLES, SILVER_DATASETS
from ..session import configure, staged
from ..sources import history
from . import jobs, publish, tables

# location key of one date's additions to ``seen``; a state whose digests were longer texts ("state_seen@")
# counts as none and is built again once
SEEN = "state_seen_16@"


def _state_of(spark: SparkSession, gold_root: str, start: str, day: str) -> tuple[gold_state.GoldState, dict[str, str]] | None:
    """The state published for ``day`` and the places of its ``seen`` files; None if there is none for this start."""
    try:
        manifest = publish.latest_manifest(spark, gold_root, day)
    except ValueError:
        return None
    places = manifest["locations"]
    if manifest["period_start"] != start or "state_claims" not in places:
        return None
    seen = {k: v for k, v in places.items() if k.startswith(SEEN)}
    if not seen:
        return None
    read = spark.read.parquet
    return gold_state.GoldState(read(places["state_claims"]), read(places["state_policies"]), read(places["state_expenses"]),
                                read(*seen.values())), seen


def _silver(spark: SparkSession, silver_root: str, start: str, end: str) -> dict[str, DataFrame]:
    return {name: history.silver_history(spark, silver_root, name, start, end)
            for name in SILVER_DATASETS}


def incremental_gold(spark: SparkSession, silver_root: str, gold_root: str, start: str, end: str,
                     run_id: str | None = None, database: str | None = None) -> dict:
    """Gold for [start, end] from the state of the day before ``end`` and the Silver rows of ``end``."""
    configure(spark)
    first, last = window(start, end)
    run_id = run_id or publish.new_run_id()
    generation = publish.claim_generation(spark, gold_root, end)
    before = _state_of(spark, gold_root, start, (last - timedelta(days=1)).isoformat()) if last > first else None
    state, seen = before or (None, {})
    locations, rows = dict(seen), {}

    def write(table: str, df: DataFrame) -> DataFrame:
        locations[table] = publish.write_generation(df, gold_root, table, end, run_id)
        return spark.read.parquet(locations[table])

    # The state is written before it is checked: without a manifest no reader sees it.
    merge = gold_state.advance(state, _silver(spark, silver_root, end if state else start, end), start, end,
                               hold=lambda df, name: write(name, df) if name.startswith("state_") else staged(df, name))
    require_empty(violation_rows(merge.checks))
    locations[SEEN + end] = publish.write_generation(merge.seen_today, gold_root, "state_seen", end, run_id)
    after = merge.state
    built = gold_state.gold_tables(after, start, end)
    for table in GOLD_TABLES:
        out = gold.with_period(built[table], start, end)
        publish.check_contract(spark, gold_root, table, out)
        rows[table] = write(table, out).count()
    manifest = publish.write_manifest(spark, gold_root, start, end, run_id, rows, locations, generation)
    if database:
        tables.register_gold(spark, database, gold_root, {**manifest, "locations": {t: locations[t] for t in GOLD_TABLES}})
    return manifest


def valuations(deltas: list[tuple[str, dict[str, DataFrame]]], start: str) -> list[tuple[str, dict[str, DataFrame]]]:
    """The Gold tables of every date, given the rows that arrived since the date before it (no checks, no
    publication): each state is written to the shared folder and the next one starts from the files."""
    state, seen, out = None, None, []
    for end, day in deltas:
        merge = gold_state.advance(state, day, start, end, hold=staged)
        seen = merge.seen_today if seen is None else seen.unionByName(merge.seen_today)
        state = gold_state.GoldState(merge.state.claims, merge.state.policies, merge.state.expenses, seen)
        out.append((end, gold_state.gold_tables(state, start, end)))
    return out


def backfill_incremental(spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str, start: str, end: str,
                         silver_db: str | None = None, gold_db: str | None = None, payments=None) -> list[dict]:
    """Each date in ascending order: its Silver load, then its Gold from the state of the day before."""
    day, last = window(start, end)
    manifests = []
    while day <= last:
        d = day.isoformat()
        jobs.load_day(spark, bronze_root, silver_root, d, silver_db, payments)
        manifests.append(incremental_gold(spark, silver_root, gold_root, start, d, database=gold_db))
        day += timedelta(days=1)
    return manifests
