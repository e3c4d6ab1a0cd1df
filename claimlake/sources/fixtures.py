"""Insurance-shaped views derived from the driver's TPC-H-style tables.

The benchmark data holds no insurance feeds, so every query runs on frames
Spark derives from the given tables (whole tables, no sampling):

* policies   <- customer x nation x region
* exposure   <- orders (one policy-day per order)
* claims     <- lineitem x orders (one claim per order, one version per line)
* payments   <- the latest claim version when something was paid
* expenses   <- events (event type picks the expense category)

Dimension joins against ``nation``/``region`` are left to the planner: both
tables have a fixed size by specification and Spark's size estimate from the
Parquet footers decides the broadcast.  Customer and orders grow with the
data and are joined with shuffles.

The large tables are dealt out once, by the text key that the feeds carry
(claim or policy), before they are joined: later groupings and joins by that
key find their rows together and shuffle nothing again.  The number of parts
follows the row count, so a task's share does not grow with the data.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.plan import spread
from ..schemas import EXPOSURE, MONEY, PREMIUM

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)

# Default valuation window covering the whole derived history (orders start in
# 1995; expenses from events fall in 2024).
WINDOW_START = "1995-01-01"
WINDOW_END = "2024-12-31"

ROWS_A_PART = 100_000  # of a base table


@dataclass
class Tables:
    """Lazy handles on the benchmark tables (each Parquet footer read once)."""

    spark: SparkSession
    root: str

    def __post_init__(self) -> None:
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            frames = self.__dict__.setdefault("_frames", {})
            if name not in frames:
                frames[name] = spread(self.spark.read.parquet(f"{self.root}/{name}.parquet"))
            return frames[name]
        raise AttributeError(name)

    def parts(self, name: str) -> int:
        """Parts that a table is dealt out to, by its row count (from the Parquet footers)."""
        counted = self.__dict__.setdefault("_parts", {})
        if name not in counted:
            counted[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet").count() // ROWS_A_PART + 1
        return counted[name]


_OPEN: dict[tuple[int, str], Tables] = {}


def tables(spark: SparkSession, root: str) -> Tables:
    """One handle per (session, folder), so derived views are built once."""
    key = (id(spark), root.rstrip("/"))
    t = _OPEN.get(key)
    if t is None or t.spark is not spark:
        t = _OPEN[key] = Tables(spark, key[1])
    return t


def _derived(fn):
    """Memoise a derived view on its Tables handle: every query of a session
    shares one logical subtree, which Spark can then reuse."""
    @functools.wraps(fn)
    def wrapper(t: Tables) -> DataFrame:
        frames = t.__dict__.setdefault("_frames", {})
        key = "fx:" + fn.__name__
        if key not in frames:
            frames[key] = fn(t)
        return frames[key]
    return wrapper


def policy_key(c: Column) -> Column:
    """POL- and the customer key zero padded to at least seven digits
    (never truncated, so keys stay distinct at any scale)."""
    return F.format_string("POL-%07d", c.cast("bigint"))


def claim_key(c: Column) -> Column:
    return F.format_string("CLM-%09d", c.cast("bigint"))


@_derived
def policies(t: Tables) -> DataFrame:
    """One policy per customer with its rating attributes."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            "c_custkey",
            policy_key(F.col("c_custkey")).alias("policy_id"),
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.when(F.col("c_acctbal") < 0, "18-24")
            .when(F.col("c_acctbal") < 3000, "25-34")
            .when(F.col("c_acctbal") < 6000, "35-49")
            .otherwise("50+")
            .alias("age_band"),
        )
    )


@_derived
def exposure_all(t: Tables) -> DataFrame:
    """Every order becomes one earned policy-day, duplicates included."""
    n = t.parts("orders")
    o = t.orders.where("o_custkey IS NOT NULL").select(
        policy_key(F.col("o_custkey")).alias("policy_id"), "o_orderkey", "o_totalprice", "o_orderdate").repartition(n, "policy_id")
    return o.join(policies(t).where("c_custkey IS NOT NULL").repartition(n, "policy_id"), "policy_id").select(
        F.concat(F.lit("EXR-"), F.col("o_orderkey").cast("string")).alias("exposure_record_id"),
        "policy_id",
        F.col("o_orderdate").cast("date").alias("load_date"),
        "region",
        "customer_segment",
        "age_band",
        (F.pmod(F.col("o_orderkey"), F.lit(101)).cast(EXPOSURE) * F.lit(0.01).cast(EXPOSURE))
        .cast(EXPOSURE)
        .alias("earned_exposure"),
        F.col("o_totalprice").cast(PREMIUM).alias("earned_premium"),
        (F.col("o_totalprice") * F.lit(4)).cast(MONEY).alias("annual_premium"),
        "o_orderkey",
    )


@_derived
def exposure(t: Tables) -> DataFrame:
    """Accepted exposure: a policy-day reported more than once is rejected whole.

    This mirrors the Silver rule that quarantines every copy of a duplicated
    policy-day.  It is one aggregation (partial counts map-side), so a hot
    policy cannot pile its rows into one task as a window count would.
    """
    cols = ["exposure_record_id", "region", "customer_segment", "age_band",
            "earned_exposure", "earned_premium", "annual_premium"]
    grouped = exposure_all(t).groupBy("policy_id", "load_date").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.struct(*cols)).alias("_row"),
    )
    return grouped.filter(F.col("_n") == 1).select("policy_id", "load_date", "_row.*").select(
        "exposure_record_id", "policy_id", "load_date", *cols[1:]
    )


@_derived
def claim_events(t: Tables) -> DataFrame:
    """Every line item is one version of the claim opened for its order."""
    n = t.parts("lineitem")
    li = t.lineitem.where("l_orderkey IS NOT NULL").select(
        claim_key(F.col("l_orderkey")).alias("claim_id"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    ).repartition(n, "claim_id")
    o = t.orders.where("o_orderkey IS NOT NULL").select(
        claim_key(F.col("o_orderkey")).alias("claim_id"), policy_key(F.col("o_custkey")).alias("policy_id"), "o_orderdate").repartition(n, "claim_id")
    paid = (
        F.when(F.col("l_returnflag") == "N", F.lit(0.0))
        .when(F.pmod(F.col("l_partkey"), F.lit(97)) == 0, F.col("l_extendedprice") + F.lit(10.0))
        .otherwise(F.col("l_quantity"))
    )
    order_key = F.substring("claim_id", 5, 20).cast("bigint")
    return li.join(o, "claim_id").select(
        F.concat_ws("-", F.lit("EVT"), order_key.cast("string"),
                    F.col("l_linenumber").cast("string")).alias("event_id"),
        "claim_id",
        "policy_id",
        F.when(F.col("l_linenumber") == 1, "INSERT").otherwise("UPDATE").alias("operation"),
        F.col("l_linenumber").cast("int").alias("source_version"),
        F.col("l_shipdate").cast("timestamp").alias("source_updated_at"),
        F.col("o_orderdate").cast("date").alias("incident_date"),
        F.col("o_orderdate").cast("date").alias("reported_date"),
        F.when(F.col("l_linestatus") == "F", "CLOSED").otherwise("OPEN").alias("claim_status"),
        F.col("l_extendedprice").cast(MONEY).alias("incurred_amount"),
        paid.cast(MONEY).alias("paid_amount"),
        order_key.alias("l_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate",
    )


_CLAIM_COLUMNS = [
    "event_id", "claim_id", "policy_id", "operation", "source_version", "source_updated_at",
    "incident_date", "reported_date", "claim_status", "incurred_amount", "paid_amount",
]


@_derived
def claims(t: Tables) -> DataFrame:
    """One event per (claim, version): the source repeats some line numbers,
    so keep the most recent line by a total order over the line's fields."""
    return _version_rows(t, _CLAIM_COLUMNS)


def _version_rows(t: Tables, columns: list[str]) -> DataFrame:
    order = F.struct(
        F.col("source_updated_at"), F.col("incurred_amount"), F.col("l_partkey"),
        F.col("l_suppkey"), F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linestatus"),
    )
    keys = ["claim_id", "source_version"]
    return (
        claim_events(t)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*[c for c in columns if c not in keys]), order).alias("_row"))
        .select(*[c if c in keys else f"_row.{c}" for c in columns])
    )


def latest_of(versions: DataFrame) -> DataFrame:
    """The latest version of every claim; a version may be there more than once."""
    return _latest_rows(versions, _CLAIM_COLUMNS)


def _latest_rows(versions: DataFrame, columns: list[str]) -> DataFrame:
    return (
        versions
        .groupBy("claim_id")
        .agg(F.max_by(F.struct(*[c for c in columns if c != "claim_id"]),
                      F.struct("source_version", "source_updated_at")).alias("_row"))
        .select(*[c if c == "claim_id" else f"_row.{c}" for c in columns])
    )


@_derived
def latest_claims(t: Tables) -> DataFrame:
    return latest_of(claims(t))


@_derived
def payments(t: Tables) -> DataFrame:
    return payments_of(latest_claims(t))


def payments_of(latest: DataFrame) -> DataFrame:
    """One indemnity payment per paid claim; every fifth version pays one
    unit more than the claim reports, so reconciliation has differences."""
    latest = latest.filter(F.col("paid_amount") > 0)
    stamp = F.col("reported_date").cast("timestamp")
    return latest.select(
        F.concat(F.lit("PAY-"), F.col("claim_id")).alias("payment_id"),
        "claim_id",
        "policy_id",
        F.col("reported_date").alias("payment_date"),
        F.lit("INDEMNITY").alias("payment_type"),
        F.lit("CLAIMANT").alias("payee_type"),
        (F.col("paid_amount")
         + F.when(F.pmod(F.col("source_version"), F.lit(5)) == 0, F.lit(1)).otherwise(F.lit(0)))
        .cast(MONEY).alias("amount"),
        F.lit("CAD").alias("currency"),
        F.col("event_id").alias("source_event_id"),
        "source_version",
        F.lit("FIXTURE_CLAIMS").alias("source_system"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


# event_type -> (expense_category, expense_scope); fixture convention.
EVENT_EXPENSES = [
    ("click", "BROKER_COMMISSION", "POLICY"),
    ("error", "POLICY_INSPECTION", "POLICY"),
    ("purchase", "CLAIM_ADJUSTING", "CLAIM"),
    ("view", "REGIONAL_MARKETING", "PORTFOLIO"),
    ("signup", "OFFICE_RENT", "CORPORATE"),
]


def _lookup(key: Column, pairs: list[tuple[str, str]]) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


@_derived
def expenses(t: Tables) -> DataFrame:
    return expenses_of(t, _latest_rows(_version_rows(t, ["claim_id", "source_version", "source_updated_at", "policy_id"]), ["claim_id", "policy_id"]))


def expenses_of(t: Tables, owners: DataFrame) -> DataFrame:
    """Expenses from events, one per event.  A CLAIM expense attaches to the policy's lowest
    claim id, and to the policy alone when that has no claim; events of an unknown type, and
    direct costs of an unknown policy, go to the portfolio.  ``owners``: claim_id, policy_id of every claim."""
    n = t.parts("events")
    ev = t.events.select(F.when(F.col("user_id").isNotNull(), policy_key(F.col("user_id"))).alias("_user"),
                         "event_id", "ts", "event_type", "value").repartition(n, "_user")
    pol = policies(t).where("c_custkey IS NOT NULL").select(F.col("policy_id").alias("_user"), "policy_id", "region")
    first_claim = owners.groupBy(F.col("policy_id").alias("_user")).agg(F.min("claim_id").alias("_first"))
    category = _lookup(F.col("event_type"), [(e, c) for e, c, _ in EVENT_EXPENSES])
    scope = F.coalesce(_lookup(F.col("event_type"), [(e, s) for e, _, s in EVENT_EXPENSES]), F.lit("PORTFOLIO"))
    joined = (
        ev.join(pol, "_user", "left")
        .join(first_claim, "_user", "left")
        .withColumn("first_claim_id", F.when(F.col("policy_id").isNotNull(), F.col("_first")))
        .withColumn("expense_category", F.coalesce(category, F.lit("UNCLASSIFIED")))
        .withColumn("expense_scope", F.when(F.col("policy_id").isNull() & (scope != "CORPORATE"), "PORTFOLIO")
                    .when((scope == "CLAIM") & F.col("first_claim_id").isNull(), "POLICY").otherwise(scope))
    )
    stamp = F.col("ts").cast("timestamp")
    return joined.select(
        F.concat(F.lit("EXP-"), F.col("event_id").cast("string")).alias("expense_id"),
        F.col("ts").cast("date").alias("expense_date"),
        "expense_category",
        "expense_scope",
        F.col("value").cast(MONEY).alias("amount"),
        F.lit("CAD").alias("currency"),
        F.when(F.col("expense_scope") == "CLAIM", F.col("first_claim_id")).alias("claim_id"),
        F.when(F.col("expense_scope").isin("CLAIM", "POLICY"), F.col("policy_id")).alias("policy_id"),
        F.when(F.col("expense_scope") != "CORPORATE", F.col("region")).alias("region"),
        F.lit("FIXTURE_LEDGER").alias("source_system"),
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def gold_inputs(t: Tables, written: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four Silver datasets as the Gold build expects them.  ``written``: the rows of ``claims(t)``,
    derived before; payments and the claims of expenses then start from them too."""
    return {
        "claims_events": claims(t) if written is None else written,
        "daily_exposure": exposure(t),
        "claim_payments": payments(t) if written is None else payments_of(latest_of(written)),
        "expense_transactions": expenses(t) if written is None else expenses_of(t, _latest_rows(written, ["claim_id", "policy_id"])),
    }


@_derived
def policy_versions(t: Tables) -> DataFrame:  # noqa: D401
    """Effective-dated policy changes: each order date of a customer starts a
    new version carrying the order priority as coverage type; several
    orders on one day keep the highest order key."""
    o = t.orders.select(policy_key(F.col("o_custkey")).alias("policy_id"), "o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice") \
        .repartition(t.parts("orders"), "policy_id")
    per_day = o.groupBy("policy_id", F.col("o_orderdate").cast("date").alias("effective_date")).agg(
        F.max_by(F.struct("o_orderkey", "o_orderpriority", "o_totalprice"), F.col("o_orderkey")).alias("_r")
    )
    return per_day.select(
        F.concat(F.lit("PCH-"), F.col("_r.o_orderkey").cast("string")).alias("policy_change_id"),
        "policy_id",
        "effective_date",
        F.col("_r.o_orderpriority").alias("coverage_type"),
        (F.col("_r.o_totalprice") * F.lit(4)).cast(MONEY).alias("annual_premium"),
        F.col("effective_date").cast("timestamp").alias("source_updated_at"),
    )


@_derived
def policy_changes(t: Tables) -> DataFrame:
    """Policy-change feed: the versions above numbered per policy in date
    order, with injected defects (unknown policy, non-increasing version,
    effective date before the update date) chosen by the change key."""
    from pyspark.sql import Window
    v = policy_versions(t)
    k = F.substring(F.col("policy_change_id"), 5, 20).cast("bigint")
    numbered = v.withColumn("_version", F.row_number().over(
        Window.partitionBy("policy_id").orderBy("effective_date")))
    return numbered.select(
        "policy_change_id",
        F.when(F.pmod(k, F.lit(29)) == 0,
               F.format_string("POL-%07d", F.substring(F.col("policy_id"), 5, 20).cast("bigint") + 10000000))
        .otherwise(F.col("policy_id")).alias("policy_id"),
        F.when(F.pmod(k, F.lit(37)) == 0, F.lit(1)).otherwise(F.col("_version")).alias("source_version"),
        "effective_date",
        "coverage_type",
        "annual_premium",
        F.when(F.pmod(k, F.lit(31)) == 0, F.date_add("effective_date", 2).cast("timestamp"))
        .otherwise(F.col("source_updated_at")).alias("source_updated_at"),
    )


@_derived
def policy_change_feed(t: Tables) -> DataFrame:
    """The policy changes as a text feed, delivered once a year, with a defect per key number: an unknown
    operation (41), an impossible date (43), a blank id (47), a negative premium (53), no coverage (67),
    a time without zone (71), rows sent twice (59) and twins that differ (61)."""
    from pyspark.sql import Window
    k = F.regexp_extract("policy_change_id", "([0-9]+)", 1).cast("bigint")

    def hit(n: int) -> Column:
        return F.pmod(k, F.lit(n)) == 0

    by_date = Window.partitionBy("policy_id").orderBy("effective_date", "policy_change_id")
    day = F.date_format("effective_date", "yyyy-MM-dd")
    rows = policy_changes(t).select(
        F.when(hit(47), " ").otherwise(F.col("policy_change_id")).alias("policy_change_id"), "policy_id",
        F.when(hit(41), "RENEW").when(F.col("source_version") == 1, " insert").otherwise("UPDATE").alias("operation"),
        F.col("source_version").cast("string").alias("source_version"),
        F.when(hit(43), "2026-13-01").otherwise(day).alias("effective_date"),
        F.lit("coverage_and_premium").alias("change_type"),
        F.lag("coverage_type").over(by_date).alias("old_coverage_type"),
        F.when(hit(67), "").otherwise(F.col("coverage_type")).alias("new_coverage_type"),
        F.lag("annual_premium").over(by_date).cast("string").alias("old_annual_premium"),
        F.when(hit(53), "-1.00").otherwise(F.col("annual_premium").cast("string")).alias("new_annual_premium"),
        F.lit("FIXTURE_POLICY_ADMIN").alias("source_system"),
        F.concat(F.date_format("source_updated_at", "yyyy-MM-dd'T'HH:mm:ss"), F.when(hit(71), "").otherwise("+00:00")).alias("source_updated_at"),
        F.lit("policy_changes.csv").alias("source_file"),
        F.make_date(F.year("effective_date"), F.lit(12), F.lit(31)).alias("load_date"),
        F.array_compact(F.array(F.lit("own"), F.when(hit(59), "same"), F.when(hit(61), "twin"))).alias("copies"))
    copy = rows.withColumn("copy", F.explode("copies")).drop("copies")
    return copy.withColumn("new_annual_premium", F.when(F.col("copy") == "twin", "7.77").otherwise(F.col("new_annual_premium"))).drop("copy")


@_derived
def policy_terms(t: Tables) -> DataFrame:
    """Cover periods with ends of their own: each order opens one for up to 699 days (every 97th for ever),
    so terms of one policy nest, overlap, leave gaps and meet."""
    k = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("date")
    return t.orders.select(
        policy_key(F.col("o_custkey")).alias("policy_id"), start.alias("valid_from"),
        F.when(F.pmod(k, F.lit(97)) != 0, F.date_add(start, (F.pmod(k, F.lit(699)) + 1).cast("int"))).alias("valid_to"))
