"""SCD2, as-of join, interval integrity, change validation, snapshot diff."""

import datetime as dt

from pyspark.sql import functions as F

from claimlake.operators import policy_history as ph


def d(s):
    return dt.date.fromisoformat(s)


def changes(spark):
    return spark.createDataFrame([
        ("PCH-1", "POL-1", 1, d("2026-01-01"), "Standard", dt.datetime(2026, 1, 1, 1)),
        ("PCH-2", "POL-1", 2, d("2026-01-11"), "Comprehensive", dt.datetime(2026, 1, 11, 1)),
        ("PCH-3", "POL-2", 1, d("2026-01-01"), "Standard", dt.datetime(2026, 1, 1, 1)),
    ], "policy_change_id string, policy_id string, source_version int, effective_date date, "
       "coverage_type string, source_updated_at timestamp")


def test_scd2_intervals(spark):
    h = {r["policy_change_id"]: r for r in ph.scd2(changes(spark)).collect()}
    assert h["PCH-1"]["valid_to"] == d("2026-01-11") and not h["PCH-1"]["is_current"]
    assert h["PCH-2"]["valid_to"] is None and h["PCH-2"]["version_number"] == 2
    assert ph.interval_violations(ph.scd2(changes(spark))).count() == 0


def test_as_of_join_uses_version_effective_that_day(spark):
    facts = spark.createDataFrame(
        [("POL-1", d("2026-01-10")), ("POL-1", d("2026-01-11")), ("POL-2", d("2025-12-31"))],
        "policy_id string, load_date date")
    out = {(r["policy_id"], r["load_date"]): r["coverage_type"] for r in
           ph.as_of_join(facts, ph.scd2(changes(spark)), "policy_id", "load_date", ["coverage_type"]).collect()}
    assert out[("POL-1", d("2026-01-10"))] == "Standard"
    assert out[("POL-1", d("2026-01-11"))] == "Comprehensive"
    assert out[("POL-2", d("2025-12-31"))] is None


def test_interval_overlap_and_gap(spark):
    hist = spark.createDataFrame([
        ("POL-1", d("2026-01-01"), d("2026-01-10")), ("POL-1", d("2026-01-05"), d("2026-01-20")),
        ("POL-1", d("2026-01-25"), None)], "policy_id string, valid_from date, valid_to date")
    problems = [r["problem"] for r in ph.interval_violations(hist).orderBy("valid_from").collect()]
    assert problems == ["overlap", "gap"]


def test_change_validation(spark):
    policies = spark.createDataFrame([("POL-1",), ("POL-2",)], "policy_id string")
    bad = changes(spark).unionByName(spark.createDataFrame([
        ("PCH-4", "POL-1", 2, d("2026-01-20"), "X", dt.datetime(2026, 1, 21, 1)),
        ("PCH-5", "POL-9", 1, d("2026-01-20"), "X", dt.datetime(2026, 1, 20, 1)),
    ], changes(spark).schema))
    out = {r["policy_change_id"]: r["problems"] for r in ph.change_violations(bad, policies).collect()}
    assert out == {
        "PCH-4": "source_version does not increase; effective_date is before the update's business date",
        "PCH-5": "policy does not exist",
    }


def test_snapshot_diff(spark):
    a = spark.createDataFrame([("POL-1", 1), ("POL-2", 2)], "policy_id string, v int")
    b = spark.createDataFrame([("POL-1", 1), ("POL-2", 3)], "policy_id string, v int")
    diff = {(r["policy_id"], r["v"], r["change"]) for r in ph.snapshot_diff(a, b).collect()}
    assert diff == {("POL-2", 2, "removed"), ("POL-2", 3, "added")}
    assert ph.snapshot_diff(a, a).count() == 0


def test_snapshot_diff_reads_each_side_once_and_keeps_copies(spark):
    a = spark.createDataFrame([("P1", 1.0), ("P1", 1.0), ("P1", 1.0), ("P2", None), ("P3", 3.0)], "policy_id string, v double")
    b = spark.createDataFrame([("P1", 1.0), ("P2", None), ("P3", 4.0), ("P3", 4.0)], "policy_id string, v double")
    diff = ph.snapshot_diff(a, b)
    assert diff._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r["policy_id"], r["v"], r["change"]) for r in diff.collect()) == [
        ("P1", 1.0, "removed"), ("P1", 1.0, "removed"), ("P3", 3.0, "removed"), ("P3", 4.0, "added"), ("P3", 4.0, "added")]
