"""Silver rules: one defect per row, exact dq_errors text and order."""

import pytest
from pyspark.sql import functions as F

from claimlake.operators import silver
from claimlake.schemas import CLAIM_EVENT_FIELDS, EXPENSES, EXPOSURE_FEED_FIELDS, PAYMENTS, payments_v2
from tests import frames

DAY = "2026-01-05"

GOOD_CLAIM = {
    "event_id": "EVT-1", "claim_id": "CLM-1", "policy_id": "POL-1", "operation": " insert ",
    "source_version": "1", "source_updated_at": "2026-01-05T06:00:00+00:00", "incident_date": "2026-01-04",
    "reported_date": "2026-01-05", "arrival_timestamp": "2026-01-05T07:00:00-05:00", "incident_type": "Glass",
    "claim_status": "open", "incurred_amount": "100.005", "paid_amount": "0", "police_reported": "unknown",
    "fraud_score": "5", "manual_review_required": "y",
}


def claim_frame(spark, rows):
    data = [[r.get(f) for f in CLAIM_EVENT_FIELDS] + ["f.csv", DAY] for r in rows]
    cols = ",".join(f"{c} string" for c in CLAIM_EVENT_FIELDS + ["source_file", "load_date"])
    return spark.createDataFrame(data, cols).withColumn("load_date", F.col("load_date").cast("date"))


@pytest.mark.parametrize("change,expected", [
    ({}, ""),
    ({"event_id": ""}, "event_id is missing"),
    ({"claim_id": None}, "claim_id is missing"),
    ({"policy_id": "  "}, "policy_id is missing"),
    ({"operation": None}, "operation is missing"),
    ({"operation": "merge"}, "operation is invalid"),
    ({"source_version": "0"}, "source_version is invalid"),
    ({"source_version": "1.5"}, "source_version is invalid"),
    ({"source_updated_at": "2026-01-05T06:00:00"}, "source_updated_at is invalid"),
    ({"incident_date": "2026-02-30"}, "incident_date is invalid"),
    ({"reported_date": "x"}, "reported_date is invalid"),
    ({"reported_date": "2026-01-01"}, "reported_date is before incident_date"),
    ({"arrival_timestamp": ""}, "arrival_timestamp is invalid"),
    ({"incident_type": ""}, "incident_type is missing"),
    ({"claim_status": None}, "claim_status is missing"),
    ({"incurred_amount": "-0.01"}, "incurred_amount is invalid"),
    ({"paid_amount": "abc"}, "paid_amount is invalid"),
    ({"police_reported": "maybe"}, "police_reported is invalid"),
    ({"fraud_score": "101"}, "fraud_score is invalid"),
    ({"manual_review_required": "perhaps"}, "manual_review_required is invalid"),
    ({"event_id": "", "incident_date": None, "fraud_score": "-1"},
     "event_id is missing; incident_date is invalid; fraud_score is invalid"),
])
def test_claim_rules(spark, change, expected):
    row = silver.checked_claims(claim_frame(spark, [dict(GOOD_CLAIM, **change)])).first()
    assert row["dq_errors"] == expected


def test_claim_typing_and_dedup(spark):
    rows = [GOOD_CLAIM, dict(GOOD_CLAIM, source_version="2", incurred_amount="7"),
            dict(GOOD_CLAIM, event_id="EVT-2"), dict(GOOD_CLAIM, event_id="")]
    result = silver.silver_claims(claim_frame(spark, rows))
    valid = {r["event_id"]: r for r in result.valid.collect()}
    assert set(valid) == {"EVT-1", "EVT-2"}
    assert valid["EVT-1"]["source_version"] == 2 and str(valid["EVT-1"]["incurred_amount"]) == "7.00"
    r = valid["EVT-2"]
    assert r["operation"] == "INSERT" and r["claim_status"] == "OPEN" and r["police_reported"] == "UNKNOWN"
    assert str(r["incurred_amount"]) == "100.01"  # decimal cast rounds half-up
    assert r["manual_review_required"] is True
    assert r["arrival_timestamp"].hour == 12  # -05:00 normalised to UTC
    assert result.quarantine.count() == 1


def exposure_frame(spark, rows):
    data = [list(r) + ["f.csv", DAY] for r in rows]
    cols = ",".join(f"{c} string" for c in EXPOSURE_FEED_FIELDS + ["source_file", "load_date"])
    return spark.createDataFrame(data, cols).withColumn("load_date", F.col("load_date").cast("date"))


def test_exposure_rules_and_duplicates(spark):
    rows = [
        ("EXR-1", "POL-1", "Ontario", "Std", "35-49", "0.01", "1.5", "100"),
        ("EXR-2", "POL-2", "unknown_region", "Std", "35-49", "1.01", "-1", ""),
        ("EXR-3", "POL-3", "Ontario", "Std", "35-49", "0.5", "1", "1"),
        ("EXR-3", "POL-4", "Ontario", "Std", "35-49", "0.5", "1", "1"),
        ("EXR-5", "POL-5", "Ontario", "Std", "", "x", "1", "1"),
        ("EXR-6", "POL-5", "Ontario", "Std", "35-49", "0.5", "1", "1"),
    ]
    checked = {(r["exposure_record_id"], r["policy_id"]): r for r in
               silver.checked_exposure(exposure_frame(spark, rows)).collect()}
    assert checked[("EXR-1", "POL-1")]["dq_errors"] == ""
    assert checked[("EXR-2", "POL-2")]["dq_errors"] == (
        "earned_exposure is outside the expected range; earned_premium is invalid; annual_premium is invalid")
    assert checked[("EXR-2", "POL-2")]["region_quality_flag"] == "UNKNOWN"
    assert checked[("EXR-3", "POL-3")]["dq_errors"] == "duplicate exposure_record_id"
    # An invalid twin still condemns the valid row of the same policy.
    assert checked[("EXR-5", "POL-5")]["dq_errors"] == (
        "age_band is missing; earned_exposure is invalid; duplicate policy_id for processing date")
    assert checked[("EXR-6", "POL-5")]["dq_errors"] == "duplicate policy_id for processing date"
    result = silver.silver_exposure(exposure_frame(spark, rows))
    assert [r["exposure_record_id"] for r in result.valid.collect()] == ["EXR-1"]


HEADER = ",".join(PAYMENTS.fields)
GOOD_PAY = "PAY-1,CLM-1,POL-1,2026-01-05,indemnity,claimant,12.50,cad,EVT-1,07,SRC,2026-01-05T06:00:00Z,2026-01-05T08:30:00.5+02:00"


def lines(spark, values):
    return spark.createDataFrame([(v, "p.csv", DAY) for v in values], "value string, source_file string, load_date string") \
        .withColumn("load_date", F.col("load_date").cast("date"))


def test_payment_normalisation(spark):
    result = silver.silver_ledger(lines(spark, ["\ufeff" + HEADER, GOOD_PAY]), PAYMENTS)
    (row,) = result.valid.collect()
    assert row["payment_type"] == "INDEMNITY" and row["payee_type"] == "CLAIMANT" and row["currency"] == "CAD"
    assert str(row["amount"]) == "12.50" and row["source_version"] == 7
    assert row["updated_at"].isoformat() == "2026-01-05T06:30:00.500000"
    assert result.quarantine.count() == 0


@pytest.mark.parametrize("line,expected", [
    (GOOD_PAY + ",EXTRA", "malformed CSV: wrong CSV field count"),
    ('"' + GOOD_PAY, "malformed CSV: unexpected end of data"),
    ('"PAY-1"x' + GOOD_PAY[5:], "malformed CSV: ',' expected after '\"'"),
    (GOOD_PAY.replace("12.50", "12.505"), "amount must be positive decimal(18,2), without rounding"),
    (GOOD_PAY.replace("12.50", "-3"), "amount must be positive decimal(18,2), without rounding"),
    (GOOD_PAY.replace(",cad,", ",ca,"), "currency must be a three-letter code"),
    (GOOD_PAY.replace("CLM-1", "C-1"), "claim_id has invalid format"),
    (GOOD_PAY.replace("2026-01-05,indemnity", "2026-01-06,indemnity"),
     "payment_date is after process date; created_at is before transaction date"),
    (GOOD_PAY.replace("2026-01-05,indemnity", "2026-1-05,indemnity"), "payment_date is invalid"),
    (GOOD_PAY.replace("2026-01-05T06:00:00Z", "2026-01-05T06:00:00"),
     "created_at must be an ISO timestamp with timezone"),
    (GOOD_PAY.replace("2026-01-05T08:30:00.5+02:00", "2026-01-05T05:00:00Z"), "updated_at is before created_at"),
    (GOOD_PAY.replace(",claimant,", ",lawyer,"), "payee_type is invalid"),
    (GOOD_PAY.replace(",07,", ",0,"), "source_version must be a positive integer"),
    (GOOD_PAY.replace(",SRC,", ", ,"), "source_system is missing"),
])
def test_payment_rules(spark, line, expected):
    result = silver.silver_ledger(lines(spark, [line]), PAYMENTS)
    (row,) = result.quarantine.collect()
    assert row["dq_errors"] == expected or row["dq_errors"].startswith(expected + "; ")


def test_duplicates_collapse_and_conflicts_quarantine(spark):
    values = [GOOD_PAY, GOOD_PAY.replace("12.50", "12.5"),  # same after normalisation
              GOOD_PAY.replace("PAY-1", "PAY-2"), GOOD_PAY.replace("PAY-1", "PAY-2").replace("12.50", "13")]
    result = silver.silver_ledger(lines(spark, values), PAYMENTS)
    assert [r["payment_id"] for r in result.valid.collect()] == ["PAY-1"]
    q = result.quarantine.collect()
    assert {r["dq_errors"] for r in q} == {"conflicting transaction ID within load date"} and len(q) == 2
    (m,) = result.metrics.collect()
    assert (m["input_rows"], m["valid_rows"], m["quarantine_rows"], m["duplicate_rows_collapsed"]) == (4, 1, 2, 1)


EXP = "EXP-1,2026-01-05,office_rent,CORPORATE,30,CAD,,,,SRC,2026-01-05T06:00:00Z,2026-01-05T06:00:00Z"


@pytest.mark.parametrize("line,expected", [
    (EXP, ""),
    (EXP.replace("office_rent", "TRAVEL"), "expense_category is unsupported"),
    (EXP.replace("office_rent", "BROKER_COMMISSION"), "expense_category does not match expense_scope"),
    (EXP.replace("CAD,,,,SRC", "CAD,,,ASIA,SRC"), "CORPORATE expense must have null region"),
    (EXP.replace("CAD,,,,SRC", "CAD,CLM-1,,,SRC"), "overhead must not reference a claim or policy"),
    (EXP.replace("office_rent,CORPORATE", "claim_adjusting,CLAIM"), "CLAIM expense requires claim_id and policy_id"),
    (EXP.replace("office_rent,CORPORATE", "broker_commission,POLICY").replace("CAD,,,,SRC", "CAD,CLM-1,POL-1,,SRC"),
     "POLICY expense requires policy_id and null claim_id"),
    (EXP.replace("CORPORATE", "GLOBAL"), "expense_scope is invalid; expense_category does not match expense_scope"),
])
def test_expense_rules(spark, line, expected):
    result = silver.silver_ledger(lines(spark, [line]), EXPENSES)
    rows = result.quarantine.collect()
    assert (rows[0]["dq_errors"] if rows else "") == expected


def test_payments_v2_method(spark):
    contract = payments_v2(("EFT", "CHEQUE"))
    v2 = GOOD_PAY + ",eft"
    bad = GOOD_PAY.replace("PAY-1", "PAY-2") + ",CASH"
    none = GOOD_PAY.replace("PAY-1", "PAY-3") + ","
    result = silver.silver_ledger(lines(spark, [v2, bad, none]), contract)
    valid = {r["payment_id"]: r["payment_method"] for r in result.valid.collect()}
    assert valid == {"PAY-1": "EFT", "PAY-3": None}
    assert result.quarantine.first()["dq_errors"] == "payment_method is invalid"


def test_claim_row_travels_once_in_the_deduplication(spark):
    """The greatest struct of all columns is the row itself: no second copy of it orders the versions."""
    fields = {"event_id": "E1", "claim_id": "CLM-1", "policy_id": "POL-1", "operation": "update", "source_version": "1",
              "source_updated_at": "2026-01-01T00:00:00Z", "incident_date": "2026-01-01", "reported_date": "2026-01-01",
              "arrival_timestamp": "2026-01-01T00:00:00Z", "incident_type": "Glass", "claim_status": "OPEN", "incurred_amount": "5",
              "paid_amount": "1", "police_reported": "Y", "fraud_score": "3", "manual_review_required": "true"}
    raw = frames.strings(spark, [[*{**fields, "source_version": v, "paid_amount": p}.values(), f, "2026-01-01"]
                                 for v, p, f in (("1", "1", "a"), ("2", "2", "a"), ("2", "3", "b"))], [*fields, "source_file", "load_date"])
    valid = silver.silver_claims(raw.withColumn("load_date", F.col("load_date").cast("date"))).valid
    assert "max_by" not in valid._jdf.queryExecution().executedPlan().toString()
    assert [(r["event_id"], r["source_version"], int(r["paid_amount"]), r["source_file"]) for r in valid.collect()] == [("E1", 2, 3, "b")]


def test_ledger_feeds_start_from_the_given_rows(spark, monkeypatch):
    """Two loads of one ledger share what it is derived from: the line items are read for the latest claims alone."""
    from claimlake.plans import catalog
    from claimlake.sources import bronze_fixtures
    from tests.conftest import SF_SMALL
    seen, lines_of = [], bronze_fixtures.payments_feed_versions
    monkeypatch.setattr(bronze_fixtures, "payments_feed_versions", lambda source, cutover: seen.extend(lines_of(source, cutover)) or tuple(seen))
    assert catalog.payments_v2_union(spark, SF_SMALL).count() > 0
    assert len(seen) == 2 and not any("lineitem" in f for df in seen for f in df.inputFiles())
