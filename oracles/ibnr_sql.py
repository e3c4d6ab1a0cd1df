"""Oracle SQL for the Bornhuetter-Ferguson queries."""

from __future__ import annotations

from .gold_sql import END as GOLD_END
from .gold_sql import DEFECT_CTES, FIXTURE_CTES, gold_ctes
from .gold_sql import START as GOLD_START

START, END = "1995-01-01", "2001-11-15"
ELR = "0.65"
PATTERN = [(0, "0.10"), (1, "0.25"), (2, "0.40"), (3, "0.50"), (4, "0.60"), (5, "0.70"), (6, "0.78"),
           (7, "0.85"), (8, "0.90"), (9, "0.94"), (10, "0.97"), (11, "0.99"), (12, "1.00")]
PATTERN_JSON = ('{"0": 0.10, "1": 0.25, "2": 0.40, "3": 0.50, "4": 0.60, "5": 0.70, "6": 0.78, '
                '"7": 0.85, "8": 0.90, "9": 0.94, "10": 0.97, "11": 0.99, "12": 1.00}')
# A tail of forty years: the share grows by the month, in whole per cent.
LONG_PATTERN = [(age, f"{(10 + 90 * age // 480) / 100:.2f}") for age in range(481)]


def bf_ctes(claims_source: str = "fx_claims", START: str = START, END: str = END, MONTH_END_VALUATION: bool = False,
            exposure_source: str = "fx_exposure", PATTERN: list[tuple[int, str]] = PATTERN, PATTERN_JSON: str = PATTERN_JSON) -> str:
    values, LAST_AGE = ", ".join(f"({a}, CAST({p} AS DECIMAL(18,8)))" for a, p in PATTERN), len(PATTERN) - 1
    adj = 0 if MONTH_END_VALUATION else 1
    return f"""
bf_exposure AS (SELECT DISTINCT policy_id, load_date, earned_premium FROM {exposure_source}),
bf_claims AS (
  SELECT DISTINCT claim_id, policy_id, source_version, source_updated_at, incident_date, reported_date,
         operation, incurred_amount
  FROM {claims_source}
),
bf_latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY source_version DESC, source_updated_at DESC) AS rn
    FROM bf_claims) WHERE rn = 1
),
bf_premium AS (
  SELECT CAST(date_trunc('month', load_date) AS DATE) AS accident_month,
         CAST(sum(earned_premium) AS DECIMAL(28,4)) AS earned_premium
  FROM bf_exposure GROUP BY 1
),
bf_loss AS (
  SELECT CAST(date_trunc('month', incident_date) AS DATE) AS accident_month,
         count(claim_id) AS reported_claim_count,
         CAST(sum(incurred_amount) AS DECIMAL(28,4)) AS reported_incurred_amount
  FROM bf_latest WHERE incident_date BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1
),
bf_cohorts AS (
  SELECT COALESCE(p.accident_month, l.accident_month) AS accident_month,
         COALESCE(p.earned_premium, 0) AS earned_premium,
         COALESCE(l.reported_claim_count, 0) AS reported_claim_count,
         COALESCE(l.reported_incurred_amount, 0) AS reported_incurred_amount
  FROM bf_premium p FULL OUTER JOIN bf_loss l ON p.accident_month = l.accident_month
),
bf_pattern(pattern_age, reported_proportion) AS (VALUES {values}),
bf_aged AS (
  SELECT *, CAST(greatest(0, (year(DATE '{END}') - year(accident_month)) * 12
                 + month(DATE '{END}') - month(accident_month) - {adj}) AS INTEGER) AS development_age_months
  FROM bf_cohorts
),
bf_base AS (
  SELECT a.*, p.reported_proportion, CAST({ELR} AS DECIMAL(18,8)) AS expected_loss_ratio,
         CAST(a.earned_premium * CAST({ELR} AS DECIMAL(18,8)) AS DECIMAL(28,4)) AS expected_ultimate_losses
  FROM bf_aged a LEFT JOIN bf_pattern p ON least(a.development_age_months, {LAST_AGE}) = p.pattern_age
),
bf_monthly AS (
  SELECT accident_month, earned_premium, reported_claim_count, reported_incurred_amount, development_age_months,
         reported_proportion, expected_loss_ratio, expected_ultimate_losses,
         CAST(expected_ultimate_losses * (1 - reported_proportion) AS DECIMAL(28,4)) AS estimated_ibnr,
         CAST(reported_incurred_amount + CAST(expected_ultimate_losses * (1 - reported_proportion) AS DECIMAL(28,4))
              AS DECIMAL(28,4)) AS estimated_ultimate_losses,
         DATE '{END}' AS valuation_date, DATE '{START}' AS history_start_date, 'CAD' AS currency,
         'BF_REPORTED_INCURRED' AS model_method, {str(MONTH_END_VALUATION).upper()} AS is_month_end_valuation,
         last_day(accident_month) > DATE '{END}' AS is_partial_accident_month,
         development_age_months > {LAST_AGE} AS tail_assumed_fully_developed,
         '{PATTERN_JSON}' AS reporting_pattern_json
  FROM bf_base
),
bf_portfolio AS (
  SELECT valuation_date, count(*) AS accident_months,
         CAST(sum(estimated_ibnr) AS DECIMAL(28,4)) AS portfolio_ibnr,
         CAST(sum(estimated_ultimate_losses) AS DECIMAL(28,4)) AS estimated_ultimate_losses
  FROM bf_monthly GROUP BY valuation_date
)"""


VIOLATIONS = f"""
SELECT 'Invalid exposure inputs' AS "check", concat_ws('|', policy_id, CAST(load_date AS VARCHAR)) AS key, NULL AS detail
FROM bf_exposure WHERE policy_id IS NULL OR length(trim(policy_id)) = 0 OR earned_premium IS NULL OR earned_premium < 0
UNION ALL
SELECT 'Conflicting policy-day premiums', concat_ws('|', policy_id, CAST(load_date AS VARCHAR)), CAST(count(*) AS VARCHAR)
FROM bf_exposure GROUP BY policy_id, load_date HAVING count(*) > 1
UNION ALL
SELECT 'Invalid or future-dated claim economic records', concat_ws('|', claim_id, CAST(source_version AS VARCHAR)), NULL
FROM bf_claims
WHERE claim_id IS NULL OR length(trim(claim_id)) = 0 OR policy_id IS NULL OR length(trim(policy_id)) = 0
   OR source_version IS NULL OR source_version <= 0 OR incident_date IS NULL OR reported_date IS NULL
   OR reported_date < incident_date OR reported_date > DATE '{END}' OR source_updated_at IS NULL
   OR CAST(source_updated_at AS DATE) > DATE '{END}' OR incurred_amount IS NULL OR incurred_amount < 0
UNION ALL
SELECT 'Conflicting economic fields for the same claim version',
       concat_ws('|', claim_id, CAST(source_version AS VARCHAR)), CAST(count(*) AS VARCHAR)
FROM bf_claims GROUP BY claim_id, source_version HAVING count(*) > 1
UNION ALL
SELECT 'Claim changes policy across versions', claim_id, max(policy_id)
FROM bf_claims GROUP BY claim_id HAVING count(DISTINCT policy_id) > 1
UNION ALL
SELECT 'Unsupported claim operation: resolve deletes/reversals before reserving', claim_id, operation
FROM bf_latest WHERE operation IS NULL OR operation NOT IN ('INSERT', 'UPDATE')
UNION ALL
SELECT 'Loss cohort has no positive premium denominator', CAST(accident_month AS VARCHAR), NULL
FROM bf_cohorts WHERE earned_premium <= 0 AND reported_incurred_amount > 0
"""


def _with(body: str, claims_source: str = "fx_claims") -> str:
    return "WITH " + ",".join([FIXTURE_CTES, bf_ctes(claims_source)]) + "\n" + body


# Gold and reserve over one window: the whole history, valued at its end (a month's last day).
ADJUSTED = "WITH " + ",".join([FIXTURE_CTES, gold_ctes(), bf_ctes("fx_claims", GOLD_START, GOLD_END, True)]) + """
SELECT p.valuation_date, g.reported_result_before_ibnr, p.portfolio_ibnr,
       g.reported_result_before_ibnr - p.portfolio_ibnr AS ibnr_adjusted_result
FROM g_portfolio g, bf_portfolio p"""

LONG_CTES = bf_ctes("fx_claims", GOLD_START, GOLD_END, True, PATTERN=LONG_PATTERN, PATTERN_JSON="")
LONG_TAIL = ADJUSTED.replace(bf_ctes("fx_claims", GOLD_START, GOLD_END, True), LONG_CTES)

ORACLES: dict[str, str] = {
    "ibnr_adjusted_long_tail": LONG_TAIL,
    "ibnr_long_tail": "WITH " + ",".join([FIXTURE_CTES, LONG_CTES]) + "SELECT * EXCLUDE (reporting_pattern_json) FROM bf_monthly",
    "ibnr_premium_month": _with("SELECT * FROM bf_premium"),
    "ibnr_loss_month": _with("SELECT * FROM bf_loss"),
    "ibnr_bf": _with("SELECT * FROM bf_monthly"),
    "ibnr_portfolio": _with("SELECT * FROM bf_portfolio"),
    "ibnr_violations": _with(VIOLATIONS, claims_source="fx_claims_all"),
    "ibnr_checks_fired": "WITH " + ",".join([FIXTURE_CTES, DEFECT_CTES, bf_ctes("d_claims", exposure_source="d_exposure")]) + VIOLATIONS,
    "ibnr_adjusted_result": ADJUSTED,
}
