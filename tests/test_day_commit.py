"""One commit per load date, generations that two publishers cannot share, metrics from the writes."""

import tempfile

import pytest
from pyspark.sql import functions as F

from claimlake.operators.silver import SilverResult
from claimlake.plans import day_commit, generations, jobs, publish
from tests.test_roundtrip import DAYS, bronze_day


def result(spark, valid, quarantine, collapsed=0):
    """A load of plain rows; its input count is measured as the loads do."""
    from pyspark.sql import Observation
    seen = Observation()
    rows = spark.createDataFrame([(v,) for v in valid], "v int")
    n = len(valid) + len(quarantine) + collapsed
    return SilverResult(rows.observe(seen, F.lit(n).cast("bigint").alias("input_rows"), F.lit(collapsed).cast("bigint").alias(
        "duplicate_rows_collapsed"), F.count(F.lit(1)).alias("invalid_rows")),
        spark.createDataFrame([(q,) for q in quarantine], "v int"), observations=[seen])


def values(spark, root, kind="valid"):
    return sorted(r["v"] for r in day_commit.read_days(spark, root, "feed", "2026-01-01", "2026-01-01", kind).collect())


def test_valid_and_quarantine_change_together(spark):
    root = tempfile.mkdtemp(prefix="claimlake-day-")
    day_commit.publish_day(spark, root, "feed", "2026-01-01", lambda: result(spark, [1, 2], [9], 1))
    assert (values(spark, root), values(spark, root, "quarantine")) == ([1, 2], [9])

    # the second write fails: the day stays as it was, in both parts
    broken = result(spark, [5], [6])
    broken.quarantine = broken.quarantine.select(F.raise_error(F.lit("lost")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        day_commit.publish_day(spark, root, "feed", "2026-01-01", lambda: broken)
    assert (values(spark, root), values(spark, root, "quarantine")) == ([1, 2], [9])

    # a load whose rows do not add up is not published
    wrong = result(spark, [5], [6], 1)
    wrong.quarantine = wrong.quarantine.limit(0)
    with pytest.raises(AssertionError, match="identity"):
        day_commit.publish_day(spark, root, "feed", "2026-01-01", lambda: wrong)

    day_commit.publish_day(spark, root, "feed", "2026-01-01", lambda: result(spark, [], [7]))
    assert (values(spark, root), values(spark, root, "quarantine")) == ([], [7])
    m = day_commit.load_metrics(spark, root, "feed", "2026-01-01", "2026-01-01").first()
    assert (m["input_rows"], m["valid_rows"], m["quarantine_rows"], m["duplicate_rows_collapsed"]) == (1, 0, 1, 0)
    with pytest.raises(ValueError, match="1 load dates"):
        day_commit.read_days(spark, root, "feed", "2026-01-01", "2026-01-02")


def test_a_publisher_that_started_earlier_never_wins(spark):
    root = tempfile.mkdtemp(prefix="claimlake-day-")
    place = f"{root}/_day_manifests/feed/load_date=2026-01-01"
    early = generations.claim(spark, place)
    late = generations.claim(spark, place)
    assert late == early + 1
    for number, rows in ((late, [2]), (early, [1])):  # the early one commits last
        written = day_commit.write_generation(root, "feed", "2026-01-01", number, result(spark, rows, []))
        day_commit.commit(spark, root, "feed", "2026-01-01", number, written)
    assert values(spark, root) == [2]
    with pytest.raises(Exception):  # a number is written once
        day_commit.write_generation(root, "feed", "2026-01-01", late, result(spark, [3], []))


def test_gold_manifests_follow_generations_not_clocks(spark):
    root = tempfile.mkdtemp(prefix="claimlake-gen-")
    early, late = (publish.claim_generation(spark, root, "2026-01-01") for _ in range(2))
    publish.write_manifest(spark, root, "2026-01-01", "2026-01-01", "run-late", {}, {"t": "late"}, late)
    publish.write_manifest(spark, root, "2026-01-01", "2026-01-01", "run-early", {}, {"t": "early"}, early)
    assert publish.latest_manifest(spark, root, "2026-01-01")["run_id"] == "run-late"
    assert generations.claimed(spark, publish.manifest_root(root, "2026-01-01")) == [early, late]


def test_all_feeds_commit_with_their_metrics(spark):
    base = tempfile.mkdtemp(prefix="claimlake-day-")
    bronze_day(f"{base}/bronze", DAYS[1])
    got = {}
    for dataset in ("claims_events", "daily_exposure", "claim_payments", "expense_transactions"):
        m = jobs.commit_feed(spark, f"{base}/bronze", f"{base}/silver", dataset, DAYS[1])
        got[dataset] = (m["input_rows"], m["valid_rows"], m["quarantine_rows"], m["duplicate_rows_collapsed"])
        rows = day_commit.read_days(spark, f"{base}/silver", dataset, DAYS[1], DAYS[1])
        assert rows.count() == m["valid_rows"] and {str(r["load_date"]) for r in rows.collect()} <= {DAYS[1]}
    assert got["claims_events"] == (1, 1, 0, 0) and got["daily_exposure"] == (1, 1, 0, 0)
    assert got["claim_payments"] == (3, 2, 0, 1)
