"""End-to-end jobs: Bronze -> Silver per date, Silver -> Gold per valuation,
the BF IBNR job, and the date-ordered backfill that chains them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from ..functions.calendar import iso_day, window
from ..operators import gold, ibnr, silver
from ..operators.checks import require_empty, violation_rows
from ..schemas import EXPENSES, GOLD_TABLES, PAYMENTS, SILVER_DATASETS, LedgerContract
from ..session import configure
from ..sources import bronze, history
from . import day_commit, publish, tables


# ---------------------------------------------------------------------------
# Bronze -> Silver
# ---------------------------------------------------------------------------

def _replace_day(spark, silver_root: str, dataset: str, day: str, result: silver.SilverResult, database: str | None) -> None:
    """The table's contract first; then the day's partitions; then their registration."""
    schema = result.valid.drop("load_date").schema
    if database:
        tables.ensure_silver_table(spark, database, dataset, silver_root, schema)
    publish.write_partition(result.valid, silver_root, dataset, day)
    publish.write_partition(result.quarantine, silver_root, dataset, day, quarantine=True)
    if database:
        tables.register_silver_partition(spark, database, dataset, silver_root, day, schema)


def load_claims(spark: SparkSession, bronze_root: str, silver_root: str, day: str,
                database: str | None = None) -> dict:
    iso_day(day)
    result = silver.silver_claims(bronze.read_claims(spark, bronze_root, day))
    _replace_day(spark, silver_root, "claims_events", day, result, database)
    return {"dataset": "claims_events", "process_date": day}


def load_exposure(spark: SparkSession, bronze_root: str, silver_root: str, day: str,
                  database: str | None = None) -> dict:
    iso_day(day)
    result = silver.silver_exposure(bronze.read_exposure(spark, bronze_root, day))
    _replace_day(spark, silver_root, "daily_exposure", day, result, database)
    return {"dataset": "daily_exposure", "process_date": day}


def load_ledger(spark: SparkSession, bronze_root: str, silver_root: str, day: str,
                contract: LedgerContract, allowed: list[LedgerContract] | None = None,
                database: str | None = None) -> dict:
    """Header contract first (fails before any write), then validate,
    assert the load balance identity, then replace the day's partitions."""
    iso_day(day)
    lines, chosen, header = bronze.read_ledger_lines(spark, bronze_root, contract, day, allowed)
    result = silver.silver_ledger(lines, chosen, header)
    metrics = publish.check_load_balance(result.metrics)
    _replace_day(spark, silver_root, chosen.dataset, day, result, database)
    out = metrics[0] if metrics else {"input_rows": 0, "valid_rows": 0, "quarantine_rows": 0,
                                      "duplicate_rows_collapsed": 0}
    out = {k: v for k, v in out.items() if k != "load_date"}
    out.update({"dataset": chosen.dataset, "process_date": day})
    return out


def load_feed(spark: SparkSession, bronze_root: str, silver_root: str, dataset: str, day: str,
              payments: list[LedgerContract] | None = None, database: str | None = None) -> dict:
    """One day of one feed, from all its files.  ``payments``: the payment contracts that a header may select."""
    if dataset == "claims_events":
        return load_claims(spark, bronze_root, silver_root, day, database)
    if dataset == "daily_exposure":
        return load_exposure(spark, bronze_root, silver_root, day, database)
    if dataset == PAYMENTS.dataset:
        return load_ledger(spark, bronze_root, silver_root, day, PAYMENTS, payments, database)
    return load_ledger(spark, bronze_root, silver_root, day, EXPENSES, database=database)


def commit_feed(spark: SparkSession, bronze_root: str, silver_root: str, dataset: str, day: str,
                payments: list[LedgerContract] | None = None) -> dict:
    """``load_feed`` as one commit: valid rows, quarantine and metrics become visible together."""
    def load() -> silver.SilverResult:
        if dataset == "claims_events":
            return silver.silver_claims(bronze.read_claims(spark, bronze_root, day))
        if dataset == "daily_exposure":
            return silver.silver_exposure(bronze.read_exposure(spark, bronze_root, day))
        contract = PAYMENTS if dataset == PAYMENTS.dataset else EXPENSES
        allowed = payments if dataset == PAYMENTS.dataset else None
        return silver.silver_ledger(*bronze.read_ledger_lines(spark, bronze_root, contract, day, allowed))
    configure(spark)
    return day_commit.publish_day(spark, silver_root, dataset, day, load)


def load_day(spark: SparkSession, bronze_root: str, silver_root: str, day: str, database: str | None = None,
             payments: list[LedgerContract] | None = None) -> list[dict]:
    configure(spark)
    return [load_feed(spark, bronze_root, silver_root, dataset, day, payments, database) for dataset in SILVER_DATASETS]


# ---------------------------------------------------------------------------
# Silver -> Gold
# ---------------------------------------------------------------------------

def read_silver(spark: SparkSession, silver_root: str, start: str, end: str) -> dict[str, DataFrame]:
    return {name: history.silver_history(spark, silver_root, name, start, end) for name in SILVER_DATASETS}


def silver_to_gold(spark: SparkSession, silver_root: str, gold_root: str, start: str, end: str,
                   run_id: str | None = None, database: str | None = None) -> dict:
    """Checks, then each Gold table is written and read back before the next
    one is derived from it: every step restarts from files in the shared
    folder, so a lost executor never forces a rebuild from Bronze."""
    configure(spark)
    window(start, end)
    run_id = run_id or publish.new_run_id()
    generation = publish.claim_generation(spark, gold_root, end)
    r = gold.resolve(read_silver(spark, silver_root, start, end))
    require_empty(violation_rows(gold.gold_checks(r, start, end)))

    lazy = gold.build_gold({"claims_events": r.claims, "daily_exposure": r.exposure,
                            "claim_payments": r.payments, "expense_transactions": r.expenses},
                           start, end, check=False)
    for table in GOLD_TABLES:
        publish.check_contract(spark, gold_root, table, lazy[table])

    locations: dict[str, str] = {}
    rows: dict[str, int] = {}

    def write(table: str, df: DataFrame) -> DataFrame:
        locations[table] = publish.write_generation(df, gold_root, table, end, run_id)
        written = spark.read.parquet(locations[table])
        rows[table] = written.count()
        return written

    period = ["period_start", "period_end", "gold_processed_at"]
    snapshot = write("claim_snapshot", lazy["claim_snapshot"])
    policy = write("policy_performance", gold.with_period(
        gold.policy_performance(r.exposure, snapshot.drop(*period), r.expenses, start, end), start, end))
    summary = write("expense_summary", lazy["expense_summary"])
    write("portfolio_performance", gold.with_period(
        gold.portfolio_performance(policy.drop(*period), summary.drop(*period)), start, end))
    manifest = publish.write_manifest(spark, gold_root, start, end, run_id, rows, locations, generation)
    if database:
        tables.register_gold(spark, database, gold_root, manifest)
    return manifest


# ---------------------------------------------------------------------------
# IBNR
# ---------------------------------------------------------------------------

def ibnr_path(gold_root: str, as_of: str, model_version: str) -> str:
    return f"{gold_root.rstrip('/')}/ibnr_bf_monthly/as_of_date={as_of}/model_version={model_version}"


@dataclass(frozen=True)
class ReserveRun:
    """Where one valuation under one model version was written."""

    path: str
    model_version: str
    valuation: str


def ibnr_job(spark: SparkSession, silver_root: str, gold_root: str, start: str, end: str,
             elr_text: str, pattern_json: str, model_version: str) -> ReserveRun:
    """One immutable output per valuation date and model version (it names a folder)."""
    configure(spark)
    if not (model_version.isascii() and 0 < len(model_version) <= 100 and model_version.replace("-", "").replace("_", "").isalnum()):
        raise ValueError(f"model version {model_version!r}: up to 100 ASCII letters, digits, '-' and '_'")
    assumptions = ibnr.parse_assumptions(elr_text, pattern_json)
    inputs = [history.silver_history(spark, silver_root, name, start, end) for name in ("daily_exposure", "claims_events")]
    monthly = ibnr.ibnr_bf(*inputs, assumptions, ibnr.pattern_frame(spark, assumptions), start, end)
    run = ReserveRun(ibnr_path(gold_root, end, model_version), model_version, end)
    monthly.repartition(1).write.mode("errorifexists").parquet(run.path)  # one row per month
    return run


# ---------------------------------------------------------------------------
# Backfill (dates in ascending order; each Gold covers start..D)
# ---------------------------------------------------------------------------

def backfill(spark: SparkSession, bronze_root: str, silver_root: str, gold_root: str,
             start: str, end: str, silver_db: str | None = None, gold_db: str | None = None,
             payments: list[LedgerContract] | None = None) -> list[dict]:
    day, last = window(start, end)
    manifests = []
    while day <= last:
        d = day.isoformat()
        load_day(spark, bronze_root, silver_root, d, silver_db, payments)
        manifests.append(silver_to_gold(spark, silver_root, gold_root, start, d, database=gold_db))
        day += timedelta(days=1)
    return manifests

