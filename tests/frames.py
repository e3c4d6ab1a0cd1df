"""Small inline frames: the Gold self-test inputs (three claim versions,
three exposure days, two payments sent twice, four expenses)."""

from pyspark.sql import functions as F

from claimlake.schemas import EXPENSE_FIELDS, GOLD_CLAIM_FIELDS, PAYMENT_FIELDS

EXPOSURE_COLS = ["policy_id", "load_date", "region", "customer_segment", "age_band", "earned_exposure",
                 "earned_premium"]


def strings(spark, rows, cols):
    return spark.createDataFrame(rows, ",".join(f"{c} string" for c in cols))


def claims(spark):
    df = strings(spark, [
        ["CLM-1", "POL-1", "1", "2026-01-01T06:00:00Z", "2026-01-01", "2026-01-01", "INSERT", "OPEN", "100", "0"],
        ["CLM-1", "POL-1", "2", "2026-01-02T06:00:00Z", "2026-01-01", "2026-01-01", "UPDATE", "CLOSED", "120", "100"],
        ["CLM-2", "POL-3", "1", "2026-01-01T06:00:00Z", "2026-01-01", "2026-01-01", "INSERT", "OPEN", "10", "0"],
    ], GOLD_CLAIM_FIELDS)
    return (df.withColumn("source_version", F.col("source_version").cast("int"))
            .withColumn("paid_amount", F.col("paid_amount").cast("decimal(18,2)"))
            .withColumn("incurred_amount", F.col("incurred_amount").cast("decimal(18,2)"))
            .withColumn("incident_date", F.col("incident_date").cast("date"))
            .withColumn("reported_date", F.col("reported_date").cast("date"))
            .withColumn("source_updated_at", F.col("source_updated_at").cast("timestamp")))


def exposure(spark):
    df = strings(spark, [
        ["POL-1", "2026-01-01", "Ontario", "Standard", "35-49", "0.01", "100"],
        ["POL-1", "2026-01-02", "Ontario", "Standard", "35-49", "0.01", "100"],
        ["POL-2", "2026-01-01", "Ontario", "Standard", "35-49", "0.01", "100"],
    ], EXPOSURE_COLS)
    return (df.withColumn("earned_premium", F.col("earned_premium").cast("decimal(18,8)"))
            .withColumn("earned_exposure", F.col("earned_exposure").cast("decimal(18,8)"))
            .withColumn("load_date", F.col("load_date").cast("date")))


def payments(spark):
    df = strings(spark, [
        ["PAY-1", "CLM-1", "POL-1", "2026-01-02", "INDEMNITY", "CLAIMANT", "60", "CAD", "EVT-2", "2", "TEST",
         "2026-01-02", "2026-01-02"],
        ["PAY-2", "CLM-1", "POL-1", "2026-01-02", "INDEMNITY", "CLAIMANT", "40", "CAD", "EVT-2", "2", "TEST",
         "2026-01-02", "2026-01-02"],
    ], PAYMENT_FIELDS)
    return (df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
            .withColumn("payment_date", F.col("payment_date").cast("date")))


def expenses(spark):
    df = strings(spark, [
        ["E1", "2026-01-01", "CLAIM_ADJUSTING", "CLAIM", "5", "CAD", "CLM-1", "POL-1", "Ontario", "TEST",
         "2026-01-01", "2026-01-01"],
        ["E2", "2026-01-01", "BROKER_COMMISSION", "POLICY", "15", "CAD", None, "POL-1", "Ontario", "TEST",
         "2026-01-01", "2026-01-01"],
        ["E3", "2026-01-01", "OFFICE_RENT", "CORPORATE", "30", "CAD", None, None, None, "TEST",
         "2026-01-01", "2026-01-01"],
        ["E4", "2026-01-01", "REGIONAL_MARKETING", "PORTFOLIO", "20", "CAD", None, None, "Ontario", "TEST",
         "2026-01-01", "2026-01-01"],
    ], EXPENSE_FIELDS)
    return (df.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
            .withColumn("expense_date", F.col("expense_date").cast("date")))


def gold_inputs(spark):
    pays = payments(spark)
    return {
        "claims_events": claims(spark),
        "daily_exposure": exposure(spark),
        "claim_payments": pays.unionByName(pays),
        "expense_transactions": expenses(spark),
    }
