"""The incremental backfill equals the full build on every date, over files and on hand-made days."""

import tempfile

import pytest
from pyspark.sql import functions as F

from claimlake.operators import gold, gold_state
from claimlake.operators.checks import CheckFailed, violation_rows
from claimlake.plans import incremental, jobs, publish
from claimlake.schemas import GOLD_TABLES
from tests import frames
from tests.test_roundtrip import DAYS, bronze_day

AUDIT = ["gold_processed_at"]


def rows(df):
    df = df.drop(*[c for c in AUDIT if c in df.columns])
    return sorted((tuple(sorted((k, repr(v)) for k, v in r.asDict(recursive=True).items())) for r in df.collect()))


@pytest.fixture(scope="module")
def lake(spark):
    base = tempfile.mkdtemp(prefix="claimlake-inc-")
    for d in DAYS:
        bronze_day(f"{base}/bronze", d)
    return base, incremental.backfill_incremental(spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold", DAYS[0], DAYS[-1])


def test_incremental_backfill_over_files_equals_full_builds(spark, lake):
    base, manifests = lake
    for manifest, day in zip(manifests, DAYS):
        full = jobs.silver_to_gold(spark, f"{base}/silver", f"{base}/full", DAYS[0], day)
        assert full["rows"] == manifest["rows"]
        for table in GOLD_TABLES:
            a, b = spark.read.parquet(manifest["locations"][table]), spark.read.parquet(full["locations"][table])
            assert a.dtypes == b.dtypes and rows(a) == rows(b), (day, table)
    # the last date read its own day only, and carries on the day before's records
    assert sorted(k for k in manifests[-1]["locations"] if k.startswith(incremental.SEEN)) == [incremental.SEEN + d for d in DAYS]


START, FIRST, SECOND = "2026-01-01", "2026-01-02", "2026-01-03"


@pytest.fixture()
def days(spark):
    """The self-test frames as the first day, and an empty second day of the same schemas."""
    first = frames.gold_inputs(spark)
    return first, {name: df.limit(0) for name, df in first.items()}


def built(spark, *parts):
    state, seen, out = None, None, None
    for end, day in zip((FIRST, SECOND), parts):
        merge = gold_state.advance(state, day, START, end)
        found = sorted({r["check"] for r in violation_rows(merge.checks).collect()})
        seen = merge.seen_today if seen is None else seen.unionByName(merge.seen_today)
        state = gold_state.GoldState(merge.state.claims, merge.state.policies, merge.state.expenses, seen)
        out = gold_state.gold_tables(state, START, end)
    return found, out


def whole(spark, *parts):
    inputs = parts[0]
    for part in parts[1:]:
        inputs = {name: df.unionByName(part[name]) for name, df in inputs.items()}
    found = sorted({r["check"] for r in gold.violations(inputs, START, SECOND).collect()})
    return found, gold.build_gold(inputs, START, SECOND, check=False, processed_at=False)


def same(spark, *parts):
    (found, got), (expected, want) = built(spark, *parts), whole(spark, *parts)
    for table in GOLD_TABLES:
        assert rows(got[table]) == rows(want[table].drop("period_start", "period_end")), table
    return found, expected


def test_empty_day_changes_nothing(spark, days):
    assert same(spark, *days) == ([], [])


def test_records_sent_again_count_once(spark, days):
    first, _ = days
    again = {name: df.withColumn("load_date", F.lit(SECOND).cast("date")) if name == "daily_exposure" else df for name, df in first.items()}
    again["daily_exposure"] = again["daily_exposure"].dropDuplicates(["policy_id"])
    assert same(spark, first, again) == ([], [])


def test_later_versions_and_payments(spark, days):
    first, none = days
    claim = first["claims_events"].where("claim_id = 'CLM-2'").withColumns({
        "source_version": F.lit(2), "paid_amount": F.lit(7).cast("decimal(18,2)"), "incurred_amount": F.lit(9).cast("decimal(18,2)")})
    payment = first["claim_payments"].limit(1).withColumns({
        "payment_id": F.lit("PAY-9"), "claim_id": F.lit("CLM-2"), "policy_id": F.lit("POL-3"), "amount": F.lit(7).cast("decimal(18,2)")})
    cast = {"claims_events": claim.select([F.col(f.name).cast(f.dataType) for f in first["claims_events"].schema.fields]),
            "claim_payments": payment}
    assert same(spark, first, {**none, **cast}) == ([], [])


def test_conflicts_with_earlier_days_are_found(spark, days):
    """One day that contradicts the day before in every way; the full build refuses it too."""
    first, none = days

    def changed(dataset, **values):
        rows_of = first[dataset].where("claim_id = 'CLM-1'").limit(1)
        return rows_of.withColumns({c: F.expr(e) for c, e in values.items()}).select(
            [F.col(f.name).cast(f.dataType) for f in first[dataset].schema.fields])

    claims = changed("claims_events", claim_status="'OTHER'").unionByName(
        changed("claims_events", source_version="8", policy_id="'POL-77'")).unionByName(
        changed("claims_events", source_version="9", reported_date="date'2026-01-03'", operation="'DELETE'"))
    second = {**none, "claims_events": claims, "claim_payments": changed("claim_payments", amount="99")}
    found, _ = built(spark, first, second)
    for message in ("claims_events: conflicting business records", "claim_payments: conflicting business records", "changes policy",
                    "Payment claim/policy/date mismatch", "Claim expense relationship mismatch", "Unsupported claim operation"):
        assert any(message in check for check in found), (message, found)
    assert whole(spark, first, second)[0]


def test_violation_publishes_nothing(spark, lake):
    """A rerun whose day contradicts the state of the day before leaves the published run in force."""
    base, manifests = lake
    claims = spark.read.parquet(f"{base}/silver/claims_events/load_date={DAYS[1]}")
    bad = spark.createDataFrame(claims.withColumn("policy_id", F.lit("POL-X")).collect(), claims.schema)
    publish.write_partition(bad, f"{base}/silver", "claims_events", DAYS[1])
    with pytest.raises(CheckFailed):
        incremental.incremental_gold(spark, f"{base}/silver", f"{base}/gold", DAYS[0], DAYS[1])
    assert publish.latest_manifest(spark, f"{base}/gold", DAYS[1])["run_id"] == manifests[1]["run_id"]


def test_seen_records_travel_as_short_digests(spark, days):
    """Copies and seen records meet by a digest of 16 bytes: each side of a merge is shuffled once."""
    first, none = days
    merge = gold_state.advance(None, first, START, FIRST)
    assert {r[0] for r in merge.seen_today.select(F.length("digest")).distinct().collect()} == {16}
    again, _ = gold_state._new_records(first["claims_events"], "claims_events", merge.seen_today.localCheckpoint())
    assert again._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2 and again.count() == 0


def test_state_with_older_digests_is_built_again(spark, tmp_path):
    places = {t: "nowhere" for t in ("state_claims", "state_policies", "state_expenses", "state_seen@2026-01-01")}
    publish.write_manifest(spark, str(tmp_path), START, FIRST, "run", {}, places, 1)
    assert incremental._state_of(spark, str(tmp_path), START, FIRST) is None
