"""Policy changes from file to history: rules, splice, reruns; the interval sweep on nested versions."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from claimlake.operators import policy_history as ph
from claimlake.plans import policy_jobs
from claimlake.schemas import POLICY_CHANGE_FIELDS
from tests.test_policy_history import changes, d

DAYS = ["2026-01-01", "2026-01-11"]
FEED = {
    "2026-01-01": [
        "PCH-1,POL-1,INSERT,1,2026-01-01,NEW,,Standard,,1215.63,ADMIN,2026-01-01T00:00:00+00:00",
        "PCH-2,POL-2,insert ,1,2026-01-01,NEW,,Basic,,900,ADMIN,2026-01-01T00:00:00Z",
        "PCH-2,POL-2,INSERT,1,2026-01-01,new,,Basic,,900.00,ADMIN,2026-01-01T00:00:00Z"],
    "2026-01-11": [
        "PCH-3,POL-1,UPDATE,2,2026-01-11,COVERAGE_AND_PREMIUM,Standard,Comprehensive,1215.63,1398.00,ADMIN,2026-01-11T01:00:00+00:00",
        "PCH-4,POL-1,UPDATE,2,2026-01-12,COVERAGE,Comprehensive,Basic,1398.00,1398.00,ADMIN,2026-01-11T02:00:00+00:00",
        "PCH-5,POL-2,UPDATE,1,2026-01-12,COVERAGE,Basic,Gold,900,1,ADMIN,2026-01-11T02:00:00+00:00",
        "PCH-6,POL-9,INSERT,1,2026-01-10,NEW,,Gold,,x,ADMIN,2026-01-11T02:00:00+00:00",
        "PCH-7,POL-2"],
}


@pytest.fixture(scope="module")
def loaded(spark):
    base = tempfile.mkdtemp(prefix="claimlake-policy-")
    os.makedirs(f"{base}/bronze/policy-changes")
    for day, lines in FEED.items():
        with open(f"{base}/bronze/policy-changes/policy_changes_{day}.csv", "w") as fh:
            fh.write("\n".join([",".join(POLICY_CHANGE_FIELDS), *lines]) + "\n")
    policies = spark.createDataFrame([("POL-1",), ("POL-2",), ("POL-3",)], "policy_id string")

    def load(day):
        return policy_jobs.load_policy_changes(spark, f"{base}/bronze", f"{base}/silver", day, policies)
    return base, load, [load(day) for day in DAYS]


def chain(df):
    return sorted((r["policy_change_id"], r["valid_from"].isoformat(), r["valid_to"] and r["valid_to"].isoformat(), r["version_number"])
                  for r in df.collect())


def test_quarantine_lists_every_rule(spark, loaded):
    base, _, _ = loaded
    q = {r["policy_change_id"]: r["dq_errors"] for r in spark.read.parquet(f"{base}/silver/quarantine/policy_changes").collect()}
    assert q == {
        "PCH-4": "source_version does not increase",
        "PCH-5": "source_version does not increase",  # against the history of the earlier day
        "PCH-6": "new_annual_premium is invalid; policy does not exist; effective_date is before the update's business date",
        "PCH-7": "operation is invalid; source_version is invalid; effective_date is invalid; change_type is missing; "
                 "new_coverage_type is missing; new_annual_premium is invalid; source_updated_at is invalid",
    }


def test_history_grows_by_the_day_and_old_dates_stay(spark, loaded):
    base, load, manifests = loaded
    read = lambda day: chain(policy_jobs.read_policy_history(spark, f"{base}/silver", day))
    assert read(DAYS[0]) == [("PCH-1", "2026-01-01", None, 1), ("PCH-2", "2026-01-01", None, 1)]
    want = [("PCH-1", "2026-01-01", "2026-01-11", 1), ("PCH-2", "2026-01-01", None, 1), ("PCH-3", "2026-01-11", None, 2)]
    assert read(DAYS[1]) == want
    again = load(DAYS[1])
    assert again["run_id"] != manifests[1]["run_id"] and read(DAYS[1]) == want
    assert ph.interval_violations(policy_jobs.read_policy_history(spark, f"{base}/silver", DAYS[1])).count() == 0


def test_splice_touches_changed_keys_only(spark):
    history = ph.scd2(changes(spark))
    late = spark.createDataFrame([("PCH-9", "POL-1", 3, d("2026-01-05"), "Basic", dt.datetime(2026, 1, 12)),
                                  ("PCH-2", "POL-1", 2, d("2026-01-20"), "Moved", dt.datetime(2026, 1, 12))], changes(spark).schema)
    spliced = ph.splice(history, late)
    assert chain(spliced) == [("PCH-1", "2026-01-01", "2026-01-05", 1), ("PCH-2", "2026-01-20", None, 3),
                              ("PCH-3", "2026-01-01", None, 1), ("PCH-9", "2026-01-05", "2026-01-20", 2)]
    assert chain(ph.splice(spliced, late)) == chain(spliced)


def test_sweep_finds_nested_overlaps_gaps_and_open_ends(spark):
    def day(n):
        return n and dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rows = [("A", 1, 10), ("A", 2, 3), ("A", 3, 4), ("B", 1, 5), ("B", 5, 500), ("B", 600, None), ("B", 1200, 1300),
            ("C", 1, None), ("C", 900, 901), ("D", 4, 4), ("D", 4, 9)]
    frame = spark.createDataFrame([(k, day(a), day(b)) for k, a, b in rows], "policy_id string, valid_from date, valid_to date")
    want, reach = [], {}
    for k, a, b in sorted(rows, key=lambda r: (r[0], r[1], r[2] or 10 ** 6)):
        far = reach.get(k)
        if far is not None and far != a:
            want.append((k, day(a), day(b), None if far == 10 ** 6 else day(far), "overlap" if far > a else "gap"))
        reach[k] = max(far or 0, b or 10 ** 6)
    got = sorted(map(tuple, ph.interval_violations(frame).collect()), key=lambda r: (r[0], r[1], r[2] or dt.date.max))
    assert got == want and {r[4] for r in got} == {"overlap", "gap"}
    assert frame.where(F.lit(False)).transform(ph.interval_violations).count() == 0


def test_splice_leaves_bucketed_rows_where_their_keys_are(spark):
    """History and delivery in buckets of their policies: only ids are shuffled for the joins."""
    from claimlake.session import staged_by
    rows = spark.sql("select concat('PCH-', id) policy_change_id, concat('POL-', id % 50) policy_id, date_add(date'2026-01-01', int(id)) effective_date,"
                     " concat('plan ', id) note from range(200)")
    late = staged_by(rows.where("policy_change_id >= 'PCH-150'"), "late", "policy_id", 3)
    history = staged_by(ph.scd2(rows.where("policy_change_id < 'PCH-160'")), "history", "policy_id", 3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spliced = ph.splice(history, late, parts=3)
        plan = spliced._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange hashpartitioning(policy_id" in plan and plan.count("Exchange hashpartitioning(policy_id") == 1  # the changed chains
    whole = ph.scd2(rows)
    assert sorted(map(str, spliced.select(whole.columns).collect())) == sorted(map(str, whole.collect()))
