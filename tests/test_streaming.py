"""The file-arrival stream loads the same Silver partitions as the batch job."""

import tempfile

from claimlake.streaming import ingest
from tests.test_roundtrip import DAYS, bronze_day


def test_stream_matches_batch_and_is_incremental(spark):
    base = tempfile.mkdtemp(prefix="claimlake-stream-")
    bronze_root, silver_root, ckpt = f"{base}/bronze", f"{base}/silver", f"{base}/ckpt"
    bronze_day(bronze_root, DAYS[0])
    for ds in ("claims_events", "claim_payments"):
        ingest.start_silver_stream(spark, bronze_root, silver_root, ds, f"{ckpt}/{ds}").awaitTermination()
    assert spark.read.parquet(f"{silver_root}/claims_events").count() == 2
    # A new day lands: only it is processed on the next run.
    bronze_day(bronze_root, DAYS[1])
    for ds in ("claims_events", "claim_payments"):
        ingest.start_silver_stream(spark, bronze_root, silver_root, ds, f"{ckpt}/{ds}").awaitTermination()
    claims = spark.read.parquet(f"{silver_root}/claims_events")
    assert sorted(r["event_id"] for r in claims.collect()) == ["EVT-1", "EVT-2", "EVT-3"]
    pays = spark.read.parquet(f"{silver_root}/claim_payments")
    assert pays.count() == 2  # PAY-2 sent twice collapses
    q = spark.read.parquet(f"{silver_root}/quarantine/claims_events").collect()
    assert [r["dq_errors"] for r in q] == ["claim_id is missing"]


def test_stream_exposure_and_expenses(spark):
    base = tempfile.mkdtemp(prefix="claimlake-stream2-")
    bronze_root, silver_root, ckpt = f"{base}/bronze", f"{base}/silver", f"{base}/ckpt"
    for d in DAYS:
        bronze_day(bronze_root, d)
    for ds in ("daily_exposure", "expense_transactions"):
        ingest.start_silver_stream(spark, bronze_root, silver_root, ds, f"{ckpt}/{ds}").awaitTermination()
    exposure = spark.read.parquet(f"{silver_root}/daily_exposure")
    assert exposure.count() == 3 and set(exposure.columns) >= {"region_quality_flag", "load_date"}
    expenses = spark.read.parquet(f"{silver_root}/expense_transactions")
    assert sorted(r["expense_id"] for r in expenses.collect()) == ["E1", "E2", "E3", "E4"]
    # The day without expense rows is still a readable (empty) partition.
    assert spark.read.parquet(f"{silver_root}/expense_transactions/load_date=2026-01-02").count() == 0


def test_files_of_one_day_in_several_batches(spark):
    """Each file in a batch of its own: the second does not replace the first; a file without a day blocks nothing."""
    import shutil
    from pathlib import Path

    base = tempfile.mkdtemp(prefix="claimlake-stream3-")
    bronze_root, silver_root = f"{base}/bronze", f"{base}/silver"
    bronze_day(bronze_root, DAYS[0])
    folder = Path(bronze_root, "claims-events")
    first = folder / f"claim_events_{DAYS[0]}.csv"
    lines = first.read_text().splitlines()
    more = folder / f"claim_events_late_{DAYS[0]}.csv"
    more.write_text("\n".join([lines[0], lines[1].replace("EVT-1", "EVT-77")]) + "\n")
    (folder / f"claim_events_{DAYS[1]}.csv").write_text(lines[0] + "\n")  # a header and nothing else
    shutil.copy(first, folder / "claim_events_undated.csv")
    ingest.start_silver_stream(spark, bronze_root, silver_root, "claims_events", f"{base}/ckpt", max_files=1).awaitTermination()
    events = {r["event_id"] for r in spark.read.parquet(f"{silver_root}/claims_events/load_date={DAYS[0]}").collect()}
    assert "EVT-77" in events and len(events) >= 2
    assert spark.read.parquet(f"{silver_root}/claims_events/load_date={DAYS[1]}").count() == 0
