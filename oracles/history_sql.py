"""Oracle SQL for the policy-history queries (SCD2, as-of, checks, diff)."""

from __future__ import annotations

import re

from .gold_sql import FIXTURE_CTES, gold_ctes

VERSION_CTES = """
hv_day AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS effective_date, max(o_orderkey) AS o_orderkey
  FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
),
hv_versions AS (
  SELECT 'PCH-' || CAST(d.o_orderkey AS VARCHAR) AS policy_change_id,
         printf('POL-%07d', d.o_custkey) AS policy_id,
         d.effective_date,
         o.o_orderpriority AS coverage_type,
         CAST(o.o_totalprice * 4 AS DECIMAL(18,2)) AS annual_premium,
         CAST(d.effective_date AS TIMESTAMP) AS source_updated_at
  FROM hv_day d JOIN orders o ON o.o_orderkey = d.o_orderkey
),
hv_scd2 AS (
  SELECT *, effective_date AS valid_from,
         lead(effective_date) OVER (PARTITION BY policy_id ORDER BY effective_date) AS valid_to,
         CAST(row_number() OVER (PARTITION BY policy_id ORDER BY effective_date) AS INTEGER) AS version_number
  FROM hv_versions
),
hv_changes AS (
  SELECT policy_change_id,
         CASE WHEN CAST(substr(policy_change_id, 5) AS BIGINT) % 29 = 0
              THEN printf('POL-%07d', CAST(substr(policy_id, 5) AS BIGINT) + 10000000) ELSE policy_id END AS policy_id,
         CASE WHEN CAST(substr(policy_change_id, 5) AS BIGINT) % 37 = 0 THEN 1 ELSE version_number END AS source_version,
         effective_date, coverage_type, annual_premium,
         CASE WHEN CAST(substr(policy_change_id, 5) AS BIGINT) % 31 = 0
              THEN CAST(effective_date + 2 AS TIMESTAMP) ELSE source_updated_at END AS source_updated_at
  FROM hv_scd2
)"""

CHANGE_CHECKS = """
SELECT policy_change_id, policy_id, problems FROM (
  SELECT c.policy_change_id, c.policy_id, concat_ws('; ',
      CASE WHEN k.policy_id IS NULL THEN 'policy does not exist' END,
      CASE WHEN c.source_version <= lag(c.source_version) OVER (
                PARTITION BY c.policy_id ORDER BY c.source_updated_at, c.policy_change_id)
           THEN 'source_version does not increase' END,
      CASE WHEN c.effective_date < CAST(c.source_updated_at AS DATE)
           THEN 'effective_date is before the update''s business date' END) AS problems
  FROM hv_changes c LEFT JOIN (SELECT DISTINCT policy_id FROM fx_policy) k ON c.policy_id = k.policy_id)
WHERE length(problems) > 0"""

def _interval_problems(table: str) -> str:
    """Each version against the furthest end of all versions that begin before it."""
    return f"""
SELECT policy_id, valid_from, valid_to, CASE WHEN reach < DATE '9999-12-31' THEN reach END AS previous_valid_to,
       CASE WHEN reach > valid_from THEN 'overlap' ELSE 'gap' END AS problem
FROM (SELECT policy_id, valid_from, valid_to,
             max(ifnull(valid_to, DATE '9999-12-31')) OVER (
               PARTITION BY policy_id ORDER BY valid_from, ifnull(valid_to, DATE '9999-12-31')
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM {table})
WHERE reach <> valid_from"""


TERM_CTES = """
hv_terms AS (
  SELECT printf('POL-%07d', o_custkey) AS policy_id, CAST(o_orderdate AS DATE) AS valid_from,
         CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 699 + 1 AS INTEGER) END AS valid_to
  FROM orders
)"""

# The text feed's rows, typed: which defect a row has follows from its key.
FEED_CTES = """
hv_numbered AS (
  SELECT c.*, CAST(substr(policy_change_id, 5) AS BIGINT) AS k,
         lag(coverage_type) OVER w AS old_coverage_type, lag(annual_premium) OVER w AS old_annual_premium
  FROM hv_changes c WINDOW w AS (PARTITION BY policy_id ORDER BY effective_date, policy_change_id)
),
hv_typed AS (
  SELECT DISTINCT CASE WHEN k % 47 = 0 THEN '' ELSE policy_change_id END AS policy_change_id, policy_id,
         CASE WHEN k % 41 = 0 THEN 'RENEW' WHEN source_version = 1 THEN 'INSERT' ELSE 'UPDATE' END AS operation,
         CAST(source_version AS INTEGER) AS source_version,
         CASE WHEN k % 43 <> 0 THEN effective_date END AS effective_date, 'COVERAGE_AND_PREMIUM' AS change_type,
         old_coverage_type, CASE WHEN k % 67 <> 0 THEN coverage_type END AS new_coverage_type, old_annual_premium,
         CAST(CASE copy WHEN 'twin' THEN 7.77 ELSE CASE WHEN k % 53 = 0 THEN -1 ELSE annual_premium END END AS DECIMAL(18,2)) AS new_annual_premium,
         'FIXTURE_POLICY_ADMIN' AS source_system, CASE WHEN k % 71 <> 0 THEN source_updated_at END AS source_updated_at,
         'policy_changes.csv' AS source_file, make_date(year(effective_date), 12, 31) AS load_date
  FROM hv_numbered, (VALUES ('own'), ('same'), ('twin')) AS copies(copy)
  WHERE copy = 'own' OR (copy = 'same' AND k % 59 = 0) OR (copy = 'twin' AND k % 61 = 0)
),
hv_judged AS (
  SELECT t.*, concat_ws('; ',
    CASE WHEN policy_change_id = '' THEN 'policy_change_id is missing' END,
    CASE WHEN operation = 'RENEW' THEN 'operation is invalid' END,
    CASE WHEN effective_date IS NULL THEN 'effective_date is invalid' END,
    CASE WHEN new_coverage_type IS NULL THEN 'new_coverage_type is missing' END,
    CASE WHEN new_annual_premium < 0 THEN 'new_annual_premium is negative' END,
    CASE WHEN source_updated_at IS NULL THEN 'source_updated_at is invalid' END,
    CASE WHEN policy_id NOT IN (SELECT policy_id FROM fx_policy) THEN 'policy does not exist' END,
    CASE WHEN source_version <= lag(source_version) OVER (
              PARTITION BY policy_id ORDER BY load_date, source_updated_at NULLS FIRST, policy_change_id, source_version, operation,
                       effective_date, change_type, old_coverage_type, new_coverage_type, old_annual_premium, new_annual_premium)
         THEN 'source_version does not increase' END,
    CASE WHEN effective_date < CAST(source_updated_at AS DATE) THEN 'effective_date is before the update''s business date' END,
    CASE WHEN policy_change_id <> '' AND count(*) OVER (PARTITION BY load_date, policy_change_id) > 1
         THEN 'conflicting policy_change_id within load date' END) AS dq_errors
  FROM hv_typed t
)"""

CHANGE_COLUMNS = ("policy_change_id, policy_id, operation, source_version, effective_date, change_type, old_coverage_type, "
                  "new_coverage_type, old_annual_premium, new_annual_premium, source_system, source_updated_at")

MERGED = f"""
SELECT {CHANGE_COLUMNS}, effective_date AS valid_from, lead(effective_date) OVER w AS valid_to,
       CAST(row_number() OVER w AS INTEGER) AS version_number, lead(effective_date) OVER w IS NULL AS is_current
FROM hv_judged WHERE dq_errors = ''
WINDOW w AS (PARTITION BY policy_id ORDER BY effective_date, source_version, source_updated_at, policy_change_id)"""

AS_OF = """
SELECT e.exposure_record_id, e.policy_id, e.load_date, e.earned_premium,
       h.valid_from, h.valid_to, h.coverage_type, h.annual_premium, h.version_number
FROM fx_exposure e
LEFT JOIN hv_scd2 h ON e.policy_id = h.policy_id AND e.load_date >= h.valid_from
                   AND (h.valid_to IS NULL OR e.load_date < h.valid_to)"""

EARLIER_END = "2001-12-31"


def _earlier_gold() -> str:
    sql = re.sub(r"\bg_", "h_", gold_ctes())
    sql = sql.replace("FROM fx_payments", f"FROM fx_payments WHERE payment_date BETWEEN DATE '1995-01-01' AND DATE '{EARLIER_END}'")
    sql = sql.replace("FROM fx_expenses", f"FROM fx_expenses WHERE expense_date BETWEEN DATE '1995-01-01' AND DATE '{EARLIER_END}'")
    return sql.replace("DATE '2024-12-31'", f"DATE '{EARLIER_END}'")


DIFF = """
(SELECT *, 'removed' AS change FROM (SELECT * FROM h_policy EXCEPT ALL SELECT * FROM g_policy))
UNION ALL
(SELECT *, 'added' AS change FROM (SELECT * FROM g_policy EXCEPT ALL SELECT * FROM h_policy))"""


def _with(body: str, *extra: str) -> str:
    return "WITH " + ",".join([FIXTURE_CTES, VERSION_CTES, *extra]) + "\n" + body


MISSING_DAYS = """
SELECT CAST(d AS DATE) AS load_date
FROM generate_series(DATE '1995-01-01', DATE '2001-08-01', INTERVAL 1 DAY) AS s(d)
WHERE CAST(d AS DATE) NOT IN (SELECT DISTINCT load_date FROM fx_exposure_all)"""


VALUATIONS = ["1998-06-30", "2001-12-31", "2024-01-10", "2024-12-31"]


def _valued_gold(number: int, end: str) -> str:
    """The whole Gold build on the rows that had arrived by ``end``: a full rebuild."""
    sql = re.sub(r"\bg_", f"w{number}_", gold_ctes()).replace("DATE '2024-12-31'", f"DATE '{end}'")
    for view, arrival in (
        ("claims", "greatest(reported_date, CAST(source_updated_at AS DATE))"), ("exposure", "load_date"), ("expenses", "expense_date"),
        ("payments", "payment_date + CAST(CAST(regexp_extract(payment_id, '([0-9]+)', 1) AS BIGINT) % 90 AS INTEGER)"),
    ):
        sql = re.sub(rf"FROM fx_{view}\b", f"FROM (SELECT * FROM fx_{view} WHERE {arrival} <= DATE '{end}')", sql)
    return sql


def _valuations(table: str) -> str:
    body = " UNION ALL ".join(f"SELECT *, DATE '{end}' AS valuation_date FROM w{n}_{table}" for n, end in enumerate(VALUATIONS))
    return "WITH " + ",".join([FIXTURE_CTES, *[_valued_gold(n, end) for n, end in enumerate(VALUATIONS)]]) + "\n" + body


CELL_COLUMNS = ["region", "customer_segment", "age_band", "missing_exposure_attributes", "earned_premium", "earned_exposure",
                "reported_claim_count", "reported_incurred_amount", "source_paid_amount", "ledger_paid_amount", "direct_claim_expense",
                "direct_policy_expense", "unreconciled_claim_count", "negative_reserve_claim_count", "direct_expense",
                "reported_contribution_before_ibnr"]
CELL_DATES = ["1999-12-31", "2024-12-31"]


def _cells() -> str:
    changed = "\nUNION ALL\n".join(
        f"SELECT policy_id, 'changed' AS change, '{c}' AS \"column\", CAST(b.{c} AS VARCHAR) AS before, CAST(a.{c} AS VARCHAR) AS after "
        f"FROM w0_policy b JOIN w1_policy a USING (policy_id) WHERE b.{c} IS DISTINCT FROM a.{c}" for c in CELL_COLUMNS)
    one_side = "\nUNION ALL\n".join(
        f"SELECT policy_id, '{change}', NULL, NULL, NULL FROM {here} WHERE policy_id NOT IN (SELECT policy_id FROM {there})"
        for change, here, there in (("removed", "w0_policy", "w1_policy"), ("added", "w1_policy", "w0_policy")))
    return _two_dates() + changed + "\nUNION ALL\n" + one_side


def _two_dates() -> str:
    return "WITH " + ",".join([FIXTURE_CTES, *[_valued_gold(n, end) for n, end in enumerate(CELL_DATES)]]) + "\n"


def _digests() -> str:
    columns = sorted(["claim_id", "policy_id", "source_version", "incident_date", "incurred_amount", "ledger_paid_amount", "paid_reconciled"])
    text = "concat_ws('|', " + ", ".join(f"ifnull(CAST({c} AS VARCHAR), '<null>')" for c in columns) + ")"
    digit = f"strpos('0123456789abcdef', substr(h, i, 1)) - 1"
    return _two_dates() + ", builds(build, n) AS (VALUES (0, 0), (1, 1), (2, 0))" + ", hashed AS (" + " UNION ALL ".join(
        f"SELECT {n} AS n, md5({text}) AS h FROM w{n}_snapshot" for n in (0, 1)) + f""")
, valued AS (SELECT n, list_sum(list_transform(range(1, 16), lambda i: CAST({digit} AS HUGEINT) * CAST(pow(16, 15 - i) AS HUGEINT))) AS v FROM hashed)
SELECT CAST(build AS INTEGER) AS build, CASE n WHEN 0 THEN '{CELL_DATES[0]}' ELSE '{CELL_DATES[1]}' END AS valuation_date,
       count(*) AS rows, CAST(sum(CAST(v AS HUGEINT)) AS DECIMAL(38,0)) AS digest
FROM builds JOIN valued USING (n) GROUP BY build, n"""


PAYMENT_HEADERS = """
SELECT DISTINCT CAST(year(payment_date) AS INTEGER) AS year,
       CASE year(payment_date) % 6 WHEN 0 THEN 'v1' WHEN 1 THEN 'v1' WHEN 2 THEN 'v1' WHEN 3 THEN 'v2' END AS contract
FROM fx_payments"""

CSV_ROWS = """
SELECT exposure_record_id, policy_id,
       CASE o_orderkey % 7 WHEN 3 THEN region || ', WEST' WHEN 4 THEN NULL ELSE region END AS region,
       customer_segment, age_band, CAST(earned_exposure AS VARCHAR) AS earned_exposure,
       CASE WHEN o_orderkey % 7 <> 1 THEN CAST(earned_premium AS VARCHAR) END AS earned_premium,
       CASE WHEN o_orderkey % 7 <> 1 THEN CAST(annual_premium AS VARCHAR) END AS annual_premium,
       o_orderkey % 7 IN (1, 2) AS is_malformed, CAST(year(load_date) AS INTEGER) AS year
FROM fx_exposure_all"""

ORACLES: dict[str, str] = {
    "snapshot_cells": _cells(),
    "generation_digest": _digests(),
    "header_contract": _with(PAYMENT_HEADERS),
    "csv_load": _with(CSV_ROWS),
    "publish_roundtrip": _with("SELECT *, DATE '1995-01-01' AS period_start, DATE '2024-12-31' AS period_end, '2024-12-31' AS as_of_date FROM g_policy", gold_ctes()),
    "report_region_order": _with("""
SELECT *, row_number() OVER (ORDER BY earned_premium DESC, region) AS position FROM (
  SELECT region, count(*) AS policy_count, CAST(sum(earned_premium) AS DECIMAL(38,4)) AS earned_premium,
         CAST(sum(reported_incurred_amount) AS DECIMAL(38,4)) AS reported_incurred, CAST(sum(direct_expense) AS DECIMAL(38,4)) AS direct_expense,
         CAST(sum(reported_contribution_before_ibnr) AS DECIMAL(38,4)) AS contribution_before_ibnr
  FROM g_policy GROUP BY region)""", gold_ctes()),
    "report_expense_mix_order": _with("""
SELECT *, row_number() OVER (ORDER BY expense_scope, expense_amount DESC, expense_category) AS position FROM (
  SELECT expense_scope, expense_category, CAST(sum(expense_amount) AS DECIMAL(38,4)) AS expense_amount
  FROM g_summary GROUP BY expense_scope, expense_category)""", gold_ctes()),
    "report_unreconciled_order": _with("""
SELECT claim_id, policy_id, incurred_amount, paid_amount, ledger_paid_amount, paid_reconciliation_difference, paid_reconciled,
       row_number() OVER (ORDER BY abs(paid_reconciliation_difference) DESC, claim_id) AS position
FROM g_snapshot WHERE NOT paid_reconciled""", gold_ctes()),
    "backfill_incremental": _valuations("portfolio"),
    "backfill_incremental_policies": _valuations("policy"),
    "exposure_missing_days": _with(MISSING_DAYS),
    "scd2_history": _with("SELECT * EXCLUDE (version_number), version_number, valid_to IS NULL AS is_current FROM hv_scd2"),
    "policy_as_of": _with(AS_OF),
    "policy_change_checks": _with(CHANGE_CHECKS),
    "scd2_gaps": _with(_interval_problems("hv_scd2")),
    "interval_integrity": _with(_interval_problems("hv_terms"), TERM_CTES),
    "policy_changes_dq": _with(f"SELECT {CHANGE_COLUMNS}, source_file, dq_errors, load_date FROM hv_judged WHERE dq_errors <> ''", FEED_CTES),
    "policy_changes_silver": _with(f"SELECT {CHANGE_COLUMNS}, source_file, load_date FROM hv_judged WHERE dq_errors = ''", FEED_CTES),
    "scd2_merge": _with(MERGED, FEED_CTES),
    "snapshot_diff": _with(DIFF, gold_ctes(), _earlier_gold()),
}
