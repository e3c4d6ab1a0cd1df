"""Bronze CSV files -> Silver partitions -> Gold generations + manifest ->
reports, in a scratch folder; reruns, contracts and completeness."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from claimlake.operators import reports
from claimlake.plans import jobs, publish, tables
from claimlake.schemas import CLAIM_EVENT_FIELDS, EXPENSE_FIELDS, EXPOSURE_FEED_FIELDS, PAYMENT_FIELDS, SILVER_SCHEMAS, payments_v2
from claimlake.sources import history

DAYS = ["2026-01-01", "2026-01-02"]
PAYMENT_METHOD_HEADER = ",".join(PAYMENT_FIELDS + ["payment_method"])


def write(root, prefix, stem, day, header, rows):
    os.makedirs(f"{root}/{prefix}", exist_ok=True)
    with open(f"{root}/{prefix}/{stem}_{day}.csv", "w") as fh:
        fh.write(",".join(header) + "\n")
        for r in rows:
            fh.write(r + "\n")


def bronze_day(root, day):
    claims = {
        "2026-01-01": ["EVT-1,CLM-1,POL-1,INSERT,1,2026-01-01T06:00:00Z,2026-01-01,2026-01-01,2026-01-01T06:00:00Z,Glass,OPEN,100,0,N,5,N",
                       "EVT-3,CLM-2,POL-3,INSERT,1,2026-01-01T06:00:00Z,2026-01-01,2026-01-01,2026-01-01T06:00:00Z,Glass,OPEN,10,0,Y,5,N",
                       "EVT-9,,POL-3,INSERT,1,2026-01-01T06:00:00Z,2026-01-01,2026-01-01,2026-01-01T06:00:00Z,Glass,OPEN,10,0,Y,5,N"],
        "2026-01-02": ["EVT-2,CLM-1,POL-1,UPDATE,2,2026-01-02T06:00:00Z,2026-01-01,2026-01-01,2026-01-02T06:00:00Z,Glass,CLOSED,120,100,N,5,N"],
    }[day]
    write(root, "claims-events", "claim_events", day, CLAIM_EVENT_FIELDS, claims)
    exposure = {
        "2026-01-01": ["EXR-1,POL-1,Ontario,Standard,35-49,0.01,100,1000", "EXR-2,POL-2,Ontario,Standard,35-49,0.01,100,1000"],
        "2026-01-02": ["EXR-3,POL-1,Ontario,Standard,35-49,0.01,100,1000"],
    }[day]
    write(root, "daily-exposure", "daily_exposure", day, EXPOSURE_FEED_FIELDS, exposure)
    pays = {
        "2026-01-01": [],
        "2026-01-02": ["PAY-1,CLM-1,POL-1,2026-01-02,INDEMNITY,CLAIMANT,60,CAD,EVT-2,2,TEST,2026-01-02T06:00:00Z,2026-01-02T06:00:00Z",
                       "PAY-2,CLM-1,POL-1,2026-01-02,INDEMNITY,CLAIMANT,40.00,CAD,EVT-2,2,TEST,2026-01-02T06:00:00Z,2026-01-02T06:00:00Z",
                       "PAY-2,CLM-1,POL-1,2026-01-02,INDEMNITY,CLAIMANT,40,CAD,EVT-2,2,TEST,2026-01-02T06:00:00Z,2026-01-02T06:00:00Z"],
    }[day]
    write(root, "claim-payments", "claim_payments", day, PAYMENT_FIELDS, pays)
    exps = {
        "2026-01-01": ["E1,2026-01-01,CLAIM_ADJUSTING,CLAIM,5,CAD,CLM-1,POL-1,Ontario,TEST,2026-01-01T06:00:00Z,2026-01-01T06:00:00Z",
                       "E2,2026-01-01,BROKER_COMMISSION,POLICY,15,CAD,,POL-1,Ontario,TEST,2026-01-01T06:00:00Z,2026-01-01T06:00:00Z",
                       "E3,2026-01-01,OFFICE_RENT,CORPORATE,30,CAD,,,,TEST,2026-01-01T06:00:00Z,2026-01-01T06:00:00Z",
                       "E4,2026-01-01,REGIONAL_MARKETING,PORTFOLIO,20,CAD,,,Ontario,TEST,2026-01-01T06:00:00Z,2026-01-01T06:00:00Z"],
        "2026-01-02": [],
    }[day]
    write(root, "expense-transactions", "expense_transactions", day, EXPENSE_FIELDS, exps)


@pytest.fixture(scope="module")
def lake(spark):
    base = tempfile.mkdtemp(prefix="claimlake-rt-")
    roots = {k: f"{base}/{k}" for k in ("bronze", "silver", "gold")}
    for d in DAYS:
        bronze_day(roots["bronze"], d)
    manifests = jobs.backfill(spark, roots["bronze"], roots["silver"], roots["gold"], DAYS[0], DAYS[-1],
                              silver_db="rt_silver", gold_db="rt_gold")
    return roots, manifests


def test_silver_partitions_and_quarantine(spark, lake):
    roots, _ = lake
    claims = spark.read.parquet(f"{roots['silver']}/claims_events")
    assert claims.count() == 3 and "load_date" in claims.columns
    q = spark.read.parquet(f"{roots['silver']}/quarantine/claims_events").collect()
    assert [r["dq_errors"] for r in q] == ["claim_id is missing"]
    # An empty day is a readable, present partition.
    assert spark.read.parquet(publish.partition_path(roots["silver"], "claim_payments", "2026-01-01")).count() == 0
    history.require_complete(spark, f"{roots['silver']}/claim_payments", "claim_payments", DAYS[0], DAYS[-1])


def test_gold_via_manifest(spark, lake):
    roots, manifests = lake
    assert [m["as_of_date"] for m in manifests] == DAYS
    last = manifests[-1]
    assert last["rows"] == {"claim_snapshot": 2, "policy_performance": 3, "expense_summary": 4,
                            "portfolio_performance": 1}
    total = publish.read_gold(spark, roots["gold"], "portfolio_performance", DAYS[-1]).first()
    assert total["earned_premium"] == 300 and total["reported_incurred_amount"] == 130
    assert total["total_expense"] == 70 and total["reported_result_before_ibnr"] == 100
    assert total["ledger_paid_amount"] == 100 and total["unreconciled_claim_count"] == 0
    first_day = publish.read_gold(spark, roots["gold"], "claim_snapshot", DAYS[0])
    assert first_day.filter(~F.col("paid_reconciled")).count() == 0
    snap = publish.read_gold(spark, roots["gold"], "claim_snapshot", DAYS[-1])
    assert reports.report_unreconciled_claims(snap).count() == 0
    region = reports.report_region_contribution(
        publish.read_gold(spark, roots["gold"], "policy_performance", DAYS[-1])).collect()
    assert region[0]["region"] == "Ontario"


def test_silver_rerun_is_idempotent(spark, lake):
    roots, _ = lake
    before = spark.read.parquet(f"{roots['silver']}/claim_payments").count()
    out = jobs.load_ledger(spark, roots["bronze"], roots["silver"], DAYS[-1], jobs.PAYMENTS)
    assert out["input_rows"] == out["valid_rows"] + out["quarantine_rows"] + out["duplicate_rows_collapsed"]
    assert (out["valid_rows"], out["duplicate_rows_collapsed"]) == (2, 1)
    assert spark.read.parquet(f"{roots['silver']}/claim_payments").count() == before == 2


def test_rerun_of_gold_publishes_new_generation(spark, lake):
    roots, _ = lake
    m = jobs.silver_to_gold(spark, roots["silver"], roots["gold"], DAYS[0], DAYS[-1])
    assert publish.latest_manifest(spark, roots["gold"], DAYS[-1])["run_id"] == m["run_id"]
    with pytest.raises(Exception):
        publish.write_generation(spark.range(1), roots["gold"], "claim_snapshot", DAYS[-1], m["run_id"])


def test_header_contract_fails_before_write(spark, lake):
    roots, _ = lake
    bad = tempfile.mkdtemp(prefix="claimlake-hdr-")
    write(bad, "claim-payments", "claim_payments", "2026-01-03", PAYMENT_FIELDS + ["payment_method"],
          ["PAY-9,CLM-1,POL-1,2026-01-03,INDEMNITY,CLAIMANT,1,CAD,E,2,T,2026-01-03T06:00:00Z,2026-01-03T06:00:00Z,EFT"])
    with pytest.raises(ValueError, match="header"):
        jobs.load_ledger(spark, bad, roots["silver"], "2026-01-03", jobs.PAYMENTS)
    assert not os.path.exists(publish.partition_path(roots["silver"], "claim_payments", "2026-01-03"))


def test_missing_partition_is_reported(spark, lake):
    roots, _ = lake
    with pytest.raises(ValueError, match=r"missing Silver Parquet partitions: \['2026-01-03'\]"):
        history.require_complete(spark, f"{roots['silver']}/claims_events", "claims_events", DAYS[0], "2026-01-03")


def test_declared_schemas_are_what_the_loads_write(spark, lake):
    roots, _ = lake
    for dataset, declared in SILVER_SCHEMAS.items():
        for day in DAYS:
            found = spark.read.parquet(publish.partition_path(roots["silver"], dataset, day)).schema
            want = {f.name: f.dataType for f in declared if f.name not in ("load_date", "payment_method")}
            assert {f.name: f.dataType for f in found} == want, (dataset, day)


def test_days_of_both_payment_contracts_in_one_shape(spark, lake):
    """A day loaded under the first contract has no payment_method; no footer is opened to find that out."""
    bronze, silver = tempfile.mkdtemp(prefix="claimlake-v2b-"), tempfile.mkdtemp(prefix="claimlake-v2s-")
    v2 = payments_v2(("EFT",))
    line = "PAY-{},CLM-1,POL-1,{day},INDEMNITY,CLAIMANT,1,CAD,E,2,T,{day}T06:00:00Z,{day}T06:00:00Z"
    write(bronze, "claim-payments", "claim_payments", DAYS[0], PAYMENT_FIELDS, [line.format(1, day=DAYS[0])])
    write(bronze, "claim-payments", "claim_payments", DAYS[1], v2.fields, [line.format(2, day=DAYS[1]) + ",EFT", line.format(3, day=DAYS[1]) + ","])
    for day in DAYS:
        jobs.load_ledger(spark, bronze, silver, day, jobs.PAYMENTS, allowed=[jobs.PAYMENTS, v2])
    first = spark.read.parquet(publish.partition_path(silver, "claim_payments", DAYS[0])).columns
    assert "payment_method" not in first
    rows = history.silver_history(spark, silver, "claim_payments", DAYS[0], DAYS[1])
    assert rows.schema.names == SILVER_SCHEMAS["claim_payments"].names
    assert sorted((r["payment_id"], r["payment_method"]) for r in rows.collect()) == [("PAY-1", None), ("PAY-2", "EFT"), ("PAY-3", None)]
    only_first = history.silver_history(spark, silver, "claim_payments", DAYS[0], DAYS[0])
    assert [r["payment_method"] for r in only_first.collect()] == [None]


def test_gold_contract_guard(spark, lake):
    roots, _ = lake
    with pytest.raises(ValueError, match="schema migration"):
        publish.check_contract(spark, roots["gold"], "claim_snapshot", spark.range(1))


def test_ibnr_job_and_model_version_guard(spark, lake):
    roots, _ = lake
    out = jobs.ibnr_job(spark, roots["silver"], roots["gold"], DAYS[0], DAYS[-1], "0.65",
                        '{"0": 0.4, "1": 0.7, "2": 0.9, "3": 1.0}', "illustrative-v1")
    row = spark.read.parquet(out.path).first()
    assert row["estimated_ibnr"] == 117 and row["is_partial_accident_month"]
    with pytest.raises(Exception):
        jobs.ibnr_job(spark, roots["silver"], roots["gold"], DAYS[0], DAYS[-1], "0.65",
                      '{"0": 0.4, "1": 0.7, "2": 0.9, "3": 1.0}', "illustrative-v1")
    with pytest.raises(ValueError, match="model version"):
        jobs.ibnr_job(spark, roots["silver"], roots["gold"], DAYS[0], DAYS[-1], "0.65",
                      '{"0": 1.0}', "bad version!")


def test_catalog_tables_and_sql_reports(spark, lake):
    roots, _ = lake
    assert spark.sql("SELECT count(*) AS n FROM rt_silver.claims_events").first()["n"] == 3
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS rt_gold.portfolio_performance").collect()]
    assert parts == ["as_of_date=2026-01-01", "as_of_date=2026-01-02"]
    total = tables.report(spark, "rt_gold", "portfolio", DAYS[-1]).first()
    assert total["earned_premium"] == 300 and total["reported_result_before_ibnr"] == 100
    region = tables.report(spark, "rt_gold", "region_contribution", DAYS[-1]).collect()
    assert [r["region"] for r in region] == ["Ontario", "UNKNOWN"]
    mix = tables.report(spark, "rt_gold", "expense_mix", DAYS[-1]).collect()
    assert [r["expense_scope"] for r in mix] == ["CLAIM", "CORPORATE", "POLICY", "PORTFOLIO"]
    assert tables.report(spark, "rt_gold", "unreconciled_claims", DAYS[-1]).count() == 0
    # A re-registered Silver partition elsewhere is refused.
    with pytest.raises(ValueError, match="different location"):
        spark.sql(f"ALTER TABLE rt_silver.claims_events PARTITION (load_date = '{DAYS[0]}') "
                  f"SET LOCATION '{roots['silver']}/elsewhere'")
        tables.register_silver_partition(spark, "rt_silver", "claims_events", roots["silver"], DAYS[0],
                                         spark.table("rt_silver.claims_events").drop("load_date").schema)


def test_published_runs_start_from_written_policy_rows(spark, monkeypatch):
    """Both runs of publish_roundtrip write rows derived once, not the whole derivation twice."""
    from claimlake.plans import catalog, publish
    from tests.conftest import SF_SMALL
    seen, write = [], publish.write_generation
    monkeypatch.setattr(publish, "write_generation", lambda df, *where: seen.append(df.inputFiles()) or write(df, *where))
    assert catalog.publish_roundtrip(spark, SF_SMALL).count() > 0
    assert len(seen) == 2 and not any("lineitem" in f for files in seen for f in files)
