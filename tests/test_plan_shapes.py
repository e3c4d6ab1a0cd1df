"""Plan-shape regression tests: the properties the design relies on at scale."""

import tempfile

from pyspark.sql import functions as F

from claimlake.operators import gold, policy_history, silver
from claimlake.plans.catalog import QUERIES
from claimlake.schemas import PAYMENTS
from claimlake.sources import arrivals
from claimlake.sources import fixtures as fx
from claimlake.sources import history
from tests import frames
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_version_combines_map_side(spark):
    latest = gold.latest_versions(frames.claims(spark))
    p = plan(latest)
    assert "partial_max_by" in p  # one candidate per claim per map task before the shuffle
    assert "Window" not in p


def test_hot_claim_is_resolved_without_a_window(spark):
    # One claim holding most of the rows still collapses to its latest version.
    base = frames.claims(spark)
    hot = spark.range(2000).select(
        F.lit("CLM-HOT").alias("claim_id"), F.lit("POL-1").alias("policy_id"),
        (F.col("id") + 1).cast("int").alias("source_version"),
        F.lit("2026-01-01 06:00:00").cast("timestamp").alias("source_updated_at"),
        F.lit("2026-01-01").cast("date").alias("incident_date"),
        F.lit("2026-01-01").cast("date").alias("reported_date"),
        F.lit("UPDATE").alias("operation"), F.lit("OPEN").alias("claim_status"),
        F.col("id").cast("decimal(18,2)").alias("incurred_amount"), F.lit(0).cast("decimal(18,2)").alias("paid_amount"))
    latest = {r["claim_id"]: r for r in gold.latest_versions(base.unionByName(hot)).collect()}
    assert latest["CLM-HOT"]["source_version"] == 2000 and latest["CLM-1"]["source_version"] == 2


def test_policy_and_portfolio_plans(spark):
    out = gold.build_gold(frames.gold_inputs(spark), "2026-01-01", "2026-01-02", check=False)
    policy, portfolio = plan(out["policy_performance"]), plan(out["portfolio_performance"])
    assert "Window" not in policy and "Window" not in portfolio
    for p in (policy, portfolio):
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_registered_queries_have_no_cross_products(spark):
    for name in ("portfolio_performance", "ibnr_adjusted_result", "policy_as_of", "gold_violations"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_as_of_join_keeps_an_equi_key(spark):
    facts = spark.createDataFrame([("POL-1", "2026-01-05")], "policy_id string, d string") \
        .withColumn("d", F.col("d").cast("date"))
    hist = spark.createDataFrame([("POL-1", "2026-01-01", "Std")], "policy_id string, effective_date string, c string") \
        .withColumn("effective_date", F.col("effective_date").cast("date"))
    p = plan(policy_history.as_of_join(facts, policy_history.scd2(hist), "policy_id", "d", ["c"]))
    assert "NestedLoop" not in p and "CartesianProduct" not in p


def test_silver_loads_stay_in_the_jvm(spark):
    lines = spark.createDataFrame([("a,b", "f", "2026-01-01")], "value string, source_file string, load_date string") \
        .withColumn("load_date", F.col("load_date").cast("date"))
    result = silver.silver_ledger(lines, PAYMENTS)
    for df in (result.valid, result.quarantine, result.metrics):
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_history_scan_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="claimlake-prune-")
    for d in ("2026-01-01", "2026-01-02", "2026-01-03"):
        spark.range(1).write.parquet(f"{root}/claims_events/load_date={d}")
    df = history.silver_history(spark, root, "claims_events", "2026-01-02", "2026-01-03")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(load_date" in p and df.count() == 2


def test_scans_are_dealt_out_only_when_the_session_says_so(spark):
    from claimlake.functions.plan import INPUT_PARTITIONS, spread
    one, before = spark.range(10).coalesce(1), spark.conf.get(INPUT_PARTITIONS, None)
    try:
        spark.conf.unset(INPUT_PARTITIONS)
        assert spread(one) is one
        spark.conf.set(INPUT_PARTITIONS, "3")
        assert spread(one).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(INPUT_PARTITIONS) if before is None else spark.conf.set(INPUT_PARTITIONS, before)


def test_long_quoted_ledger_fields(spark):
    """A quoted field of any length, with many doubled quotes or commas, is walked without recursion."""
    from claimlake.operators.silver import csv_line_error
    long = ["x" * 100_000, '""' * 50_000, "," * 100_000]
    lines = [(f'a,"{v}",c',) for v in long] + [(",".join("abc" * 30_000),), ('a,"b' + "x" * 100_000,), ('a,"b"c,d',), ("a,b,c",)]
    df = spark.createDataFrame(lines, "value string").withColumn("error", csv_line_error(F.col("value"), 3))
    assert [r["error"] for r in df.collect()] == [None, None, None, "malformed CSV: wrong CSV field count",
        "malformed CSV: unexpected end of data", "malformed CSV: ',' expected after '\"'", None]


def test_feeds_are_dealt_out_once_by_the_key_they_are_grouped_by(spark, monkeypatch):
    # Claims and exposure meet their keys in one shuffle per table; resolving them adds none.
    monkeypatch.setattr(fx, "ROWS_A_PART", 500)
    t = fx.Tables(spark, SF_SMALL)
    claims = gold.latest_versions(gold.distinct_records(fx.claims(t), gold.GOLD_CLAIM_FIELDS), fields=gold.GOLD_CLAIM_FIELDS)
    snapshot = plan(gold.claim_snapshot(claims, gold.distinct_records(fx.payments(t), gold.PAYMENT_FIELDS)))
    exposure = gold.distinct_records(fx.exposure(t), gold.GOLD_EXPOSURE_FIELDS)
    for p in (plan(claims), snapshot, plan(exposure)):
        assert "REPARTITION_BY_NUM" in p and "ENSURE_REQUIREMENTS" not in p


def test_feeds_keep_unmatched_and_null_keys(spark, tmp_path):
    # Rows without an order or customer stay away; events of no customer go to the portfolio.
    root, sql = str(tmp_path), spark.sql
    sql("select 1 r_regionkey, 'ASIA' r_name").write.parquet(f"{root}/region.parquet")
    sql("select 1 n_nationkey, 1 n_regionkey").write.parquet(f"{root}/nation.parquet")
    sql("select * from values (1L, 1, 10D, 'AUTO'), (null, 1, 10D, 'AUTO') as c(c_custkey, c_nationkey, c_acctbal, c_mktsegment)") \
        .write.parquet(f"{root}/customer.parquet")
    sql("select * from values (7L, 1L, 5D, timestamp'2020-01-01'), (8L, 2L, 5D, timestamp'2020-01-01'), (null, null, 5D, timestamp'2020-01-01')"
        " as o(o_orderkey, o_custkey, o_totalprice, o_orderdate)").write.parquet(f"{root}/orders.parquet")
    sql("select k l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 2D l_quantity, 9D l_extendedprice, 'R' l_returnflag, 'F' l_linestatus,"
        " timestamp'2020-02-01' l_shipdate from values (7L), (8L), (9L), (null) as l(k)").write.parquet(f"{root}/lineitem.parquet")
    sql("select id event_id, timestamp'2024-01-01' ts, u user_id, 'purchase' event_type, 1D value from values (1L, 1L), (2L, 2L), (3L, null) as e(id, u)") \
        .write.parquet(f"{root}/events.parquet")
    t = fx.Tables(spark, root)
    assert sorted((r["event_id"], r["claim_id"], r["policy_id"]) for r in fx.claims(t).collect()) == [
        ("EVT-7-1", "CLM-000000007", "POL-0000001"), ("EVT-8-1", "CLM-000000008", "POL-0000002")]
    assert [r["exposure_record_id"] for r in fx.exposure(t).collect()] == ["EXR-7"]
    assert sorted((r["expense_id"], r["expense_scope"], r["claim_id"] or "", r["region"] or "") for r in fx.expenses(t).collect()) == [
        ("EXP-1", "CLAIM", "CLM-000000007", "ASIA"), ("EXP-2", "PORTFOLIO", "", ""), ("EXP-3", "PORTFOLIO", "", "")]


def test_arrivals_derive_payments_and_expenses_from_the_written_claims(spark):
    # The line items are joined and grouped once, for the claims; the other feeds start from files.
    t = fx.Tables(spark, SF_SMALL)
    feeds = arrivals.feeds(t)
    for name, df in feeds.items():
        assert not any("lineitem" in f for f in df.inputFiles()), name
    assert feeds["claim_payments"].select("payment_id").distinct().count() == fx.payments(t).count()
    owners = [df.where("expense_scope = 'CLAIM'").select("expense_id", "claim_id").distinct() for df in (feeds["expense_transactions"], fx.expenses(t))]
    assert owners[0].exceptAll(owners[1]).count() == owners[1].exceptAll(owners[0]).count() == 0


def test_latest_versions_do_not_wait_for_the_collapse_of_copies(spark):
    inputs = frames.gold_inputs(spark)
    inputs["claims_events"] = inputs["claims_events"].unionByName(inputs["claims_events"])
    latest = gold.resolve(inputs).latest
    assert plan(latest).count("Exchange hashpartitioning") == 1
    assert sorted((r["claim_id"], r["source_version"]) for r in latest.collect()) == [("CLM-1", 2), ("CLM-2", 1)]


def test_fired_checks_start_from_written_feeds(spark):
    # Every check reads the feeds; the joins that derive claims and exposure run once, not once a check.
    for name in ("gold_checks_fired", "ibnr_checks_fired"):
        read = QUERIES[name](spark, SF_SMALL).inputFiles()
        assert not [f for f in read if "lineitem" in f or "orders" in f], name
