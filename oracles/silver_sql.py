"""Oracle SQL for the Silver loads.

The Bronze text is re-derived from the base tables with the same injection
rules.  For the ledgers the oracle does not parse CSV: it states what each
line must parse to (fields, or NULLs plus the reason for a malformed line)
and applies the rules to that, which checks the Spark parser independently.
"""

from __future__ import annotations

from .gold_sql import FIXTURE_CTES

# ---------------------------------------------------------------------------
# Claims (C1)
# ---------------------------------------------------------------------------

CLAIMS_CTES = r"""
b_claims AS (
  SELECT
    CASE WHEN l_partkey % 17 = 0 THEN '' ELSE event_id END AS event_id,
    claim_id,
    CASE WHEN l_suppkey % 19 = 0 THEN ' ' ELSE policy_id END AS policy_id,
    CASE WHEN l_partkey % 23 = 0 THEN 'merge' WHEN l_linenumber = 1 THEN ' insert' ELSE 'update' END AS operation,
    CASE WHEN l_partkey % 29 = 0 THEN '1.5' ELSE CAST(l_linenumber AS VARCHAR) END AS source_version,
    CASE WHEN l_partkey % 31 = 0 THEN strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS source_updated_at,
    CASE WHEN l_partkey % 37 = 0 THEN '2026-13-01' ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS incident_date,
    CASE WHEN l_partkey % 41 = 0 THEN strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d')
         ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS reported_date,
    CASE WHEN l_suppkey % 43 = 0 THEN 'yesterday'
         ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || 'T06:30:00-05:00' END AS arrival_timestamp,
    CASE WHEN l_returnflag = 'R' THEN 'Collision' WHEN l_returnflag = 'A' THEN 'Glass'
         WHEN l_partkey % 47 = 0 THEN '' ELSE 'Theft' END AS incident_type,
    CASE WHEN l_linestatus = 'F' THEN 'closed' ELSE ' OPEN ' END AS claim_status,
    CASE WHEN l_partkey % 53 = 0 THEN '-1' ELSE CAST(incurred_amount AS VARCHAR) END AS incurred_amount,
    CASE WHEN l_suppkey % 59 = 0 THEN 'abc' ELSE CAST(paid_amount AS VARCHAR) END AS paid_amount,
    CASE WHEN l_partkey % 61 = 0 THEN 'MAYBE' WHEN l_suppkey % 3 = 0 THEN 'y' WHEN l_suppkey % 3 = 1 THEN 'N'
         ELSE 'unknown' END AS police_reported,
    CASE WHEN l_partkey % 67 = 0 THEN '101' ELSE CAST(l_partkey % 101 AS VARCHAR) END AS fraud_score,
    CASE WHEN l_partkey % 71 = 0 THEN 'perhaps' WHEN l_suppkey % 4 = 0 THEN 'TRUE' WHEN l_suppkey % 4 = 1 THEN 'n'
         WHEN l_suppkey % 4 = 2 THEN '1' ELSE 'false' END AS manual_review_required,
    'bronze/claims-events/claim_events_' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '.csv' AS source_file,
    CAST(o_orderdate AS DATE) AS load_date
  FROM fx_claims_all
),
t_claims AS (
  SELECT trim(event_id) AS event_id, trim(claim_id) AS claim_id, trim(policy_id) AS policy_id,
         upper(trim(operation)) AS operation,
         CASE WHEN regexp_full_match(trim(source_version), '[+-]?[0-9]+')
              THEN TRY_CAST(trim(source_version) AS INTEGER) END AS source_version,
         timezone('UTC', try_strptime(trim(source_updated_at), '%Y-%m-%dT%H:%M:%S%z')) AS source_updated_at,
         CAST(try_strptime(trim(incident_date), '%Y-%m-%d') AS DATE) AS incident_date,
         CAST(try_strptime(trim(reported_date), '%Y-%m-%d') AS DATE) AS reported_date,
         timezone('UTC', try_strptime(trim(arrival_timestamp), '%Y-%m-%dT%H:%M:%S%z')) AS arrival_timestamp,
         trim(incident_type) AS incident_type,
         upper(trim(claim_status)) AS claim_status,
         TRY_CAST(trim(incurred_amount) AS DECIMAL(18,2)) AS incurred_amount,
         TRY_CAST(trim(paid_amount) AS DECIMAL(18,2)) AS paid_amount,
         upper(trim(police_reported)) AS police_reported,
         CASE WHEN regexp_full_match(trim(fraud_score), '[+-]?[0-9]+')
              THEN TRY_CAST(trim(fraud_score) AS INTEGER) END AS fraud_score,
         CASE WHEN upper(trim(manual_review_required)) IN ('TRUE', 'Y', '1') THEN TRUE
              WHEN upper(trim(manual_review_required)) IN ('FALSE', 'N', '0') THEN FALSE END AS manual_review_required,
         source_file, load_date
  FROM b_claims
),
c_claims AS (
  SELECT *, concat_ws('; ',
    CASE WHEN event_id IS NULL OR length(event_id) = 0 THEN 'event_id is missing' END,
    CASE WHEN claim_id IS NULL OR length(claim_id) = 0 THEN 'claim_id is missing' END,
    CASE WHEN policy_id IS NULL OR length(policy_id) = 0 THEN 'policy_id is missing' END,
    CASE WHEN operation IS NULL THEN 'operation is missing' END,
    CASE WHEN operation IS NOT NULL AND operation NOT IN ('INSERT', 'UPDATE', 'DELETE') THEN 'operation is invalid' END,
    CASE WHEN source_version IS NULL OR source_version <= 0 THEN 'source_version is invalid' END,
    CASE WHEN source_updated_at IS NULL THEN 'source_updated_at is invalid' END,
    CASE WHEN incident_date IS NULL THEN 'incident_date is invalid' END,
    CASE WHEN reported_date IS NULL THEN 'reported_date is invalid' END,
    CASE WHEN reported_date < incident_date THEN 'reported_date is before incident_date' END,
    CASE WHEN arrival_timestamp IS NULL THEN 'arrival_timestamp is invalid' END,
    CASE WHEN incident_type IS NULL OR length(incident_type) = 0 THEN 'incident_type is missing' END,
    CASE WHEN claim_status IS NULL OR length(claim_status) = 0 THEN 'claim_status is missing' END,
    CASE WHEN incurred_amount IS NULL OR incurred_amount < 0 THEN 'incurred_amount is invalid' END,
    CASE WHEN paid_amount IS NULL OR paid_amount < 0 THEN 'paid_amount is invalid' END,
    CASE WHEN police_reported IS NULL OR police_reported NOT IN ('Y', 'N', 'UNKNOWN') THEN 'police_reported is invalid' END,
    CASE WHEN fraud_score IS NULL OR fraud_score < 0 OR fraud_score > 100 THEN 'fraud_score is invalid' END,
    CASE WHEN manual_review_required IS NULL THEN 'manual_review_required is invalid' END
  ) AS dq_errors
  FROM t_claims
)"""

CLAIMS_DQ = "SELECT * FROM c_claims"
CLAIMS_SILVER = """
SELECT * EXCLUDE (rn, dq_errors) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY load_date, event_id
    ORDER BY source_version DESC, source_updated_at DESC, source_file DESC, claim_id DESC, policy_id DESC,
             operation DESC, incident_date DESC, reported_date DESC, arrival_timestamp DESC, incident_type DESC,
             claim_status DESC, incurred_amount DESC, paid_amount DESC, police_reported DESC, fraud_score DESC,
             manual_review_required DESC) AS rn
  FROM c_claims WHERE dq_errors = '')
WHERE rn = 1"""

# ---------------------------------------------------------------------------
# Exposure (C2)
# ---------------------------------------------------------------------------

EXPOSURE_CTES = r"""
b_exposure AS (
  SELECT
    CASE WHEN o_orderkey % 97 = 0 THEN 'EXR-DUP-' || strftime(load_date, '%Y-%m-%d') ELSE exposure_record_id END
      AS exposure_record_id,
    CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE policy_id END AS policy_id,
    CASE WHEN o_orderkey % 83 = 0 THEN 'Unknown_Region' ELSE region END AS region,
    CASE WHEN o_orderkey % 79 = 0 THEN '  ' ELSE customer_segment END AS customer_segment,
    age_band,
    CASE WHEN o_orderkey % 73 = 0 THEN '1.5' WHEN o_orderkey % 71 = 0 THEN 'n/a'
         ELSE CAST(earned_exposure AS VARCHAR) END AS earned_exposure,
    CASE WHEN o_orderkey % 67 = 0 THEN '-5' ELSE CAST(earned_premium AS VARCHAR) END AS earned_premium,
    CASE WHEN o_orderkey % 61 = 0 THEN '' ELSE CAST(annual_premium AS VARCHAR) END AS annual_premium,
    'bronze/daily-exposure/daily_exposure_' || strftime(load_date, '%Y-%m-%d') || '.csv' AS source_file,
    load_date
  FROM fx_exposure_all
),
t_exposure AS (
  SELECT trim(exposure_record_id) AS exposure_record_id, trim(policy_id) AS policy_id, trim(region) AS region,
         trim(customer_segment) AS customer_segment, trim(age_band) AS age_band,
         TRY_CAST(trim(earned_exposure) AS DECIMAL(18,8)) AS earned_exposure,
         TRY_CAST(trim(earned_premium) AS DECIMAL(18,4)) AS earned_premium,
         TRY_CAST(trim(annual_premium) AS DECIMAL(18,2)) AS annual_premium,
         source_file, load_date
  FROM b_exposure
),
c_exposure AS (
  SELECT *,
    CASE WHEN upper(region) = 'UNKNOWN_REGION' THEN 'UNKNOWN' ELSE 'VALID' END AS region_quality_flag,
    concat_ws('; ',
      CASE WHEN exposure_record_id IS NULL OR length(exposure_record_id) = 0 THEN 'exposure_record_id is missing' END,
      CASE WHEN policy_id IS NULL OR length(policy_id) = 0 THEN 'policy_id is missing' END,
      CASE WHEN region IS NULL OR length(region) = 0 THEN 'region is missing' END,
      CASE WHEN customer_segment IS NULL OR length(customer_segment) = 0 THEN 'customer_segment is missing' END,
      CASE WHEN age_band IS NULL OR length(age_band) = 0 THEN 'age_band is missing' END,
      CASE WHEN earned_exposure IS NULL THEN 'earned_exposure is invalid' END,
      CASE WHEN earned_exposure < 0 OR earned_exposure > 1 THEN 'earned_exposure is outside the expected range' END,
      CASE WHEN earned_premium IS NULL OR earned_premium < 0 THEN 'earned_premium is invalid' END,
      CASE WHEN annual_premium IS NULL OR annual_premium < 0 THEN 'annual_premium is invalid' END,
      CASE WHEN id_count > 1 THEN 'duplicate exposure_record_id' END,
      CASE WHEN policy_count > 1 THEN 'duplicate policy_id for processing date' END
    ) AS dq_errors
  FROM (SELECT *,
          count(*) OVER (PARTITION BY load_date, exposure_record_id) AS id_count,
          count(*) OVER (PARTITION BY load_date, policy_id) AS policy_count
        FROM t_exposure)
)"""

EXPOSURE_DQ = """
SELECT exposure_record_id, policy_id, region, customer_segment, age_band, earned_exposure, earned_premium,
       annual_premium, source_file, region_quality_flag, dq_errors, load_date
FROM c_exposure"""

# ---------------------------------------------------------------------------
# Ledgers (C3, C4)
# ---------------------------------------------------------------------------

PAYMENT_FIELDS = ["payment_id", "claim_id", "policy_id", "payment_date", "payment_type", "payee_type", "amount",
                  "currency", "source_event_id", "source_version", "source_system", "created_at", "updated_at"]
EXPENSE_FIELDS = ["expense_id", "expense_date", "expense_category", "expense_scope", "amount", "currency",
                  "claim_id", "policy_id", "region", "source_system", "created_at", "updated_at"]

PAYMENT_TEXT = r"""
SELECT CAST(substr(claim_id, 5) AS BIGINT) AS k, payment_date AS load_date,
  payment_id,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 53 = 0 THEN 'CLAIM-' || CAST(CAST(substr(claim_id, 5) AS BIGINT) AS VARCHAR)
       ELSE claim_id END AS claim_id,
  policy_id,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 29 = 0 THEN strftime(payment_date + 1, '%Y-%m-%d')
       ELSE strftime(payment_date, '%Y-%m-%d') END AS payment_date,
  'indemnity' AS payment_type,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 43 = 0 THEN 'LAWYER' ELSE payee_type END AS payee_type,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 23 = 0 THEN '1.005' ELSE CAST(amount AS VARCHAR) END AS amount,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 17 = 0 THEN 'CA' ELSE 'cad' END AS currency,
  source_event_id,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 47 = 0 THEN '0' ELSE CAST(source_version AS VARCHAR) END AS source_version,
  source_system,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 31 = 0 THEN strftime(payment_date, '%Y-%m-%d') || 'T06:00:00'
       WHEN CAST(substr(claim_id, 5) AS BIGINT) % 41 = 0 THEN strftime(payment_date - 1, '%Y-%m-%d') || 'T06:00:00Z'
       ELSE strftime(payment_date, '%Y-%m-%d') || 'T06:00:00Z' END AS created_at,
  CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 37 = 0 THEN strftime(payment_date, '%Y-%m-%d') || 'T05:00:00+00:00'
       ELSE strftime(payment_date, '%Y-%m-%d') || 'T08:30:00.250000+02:00' END AS updated_at
FROM fx_payments"""

EXPENSE_TEXT = r"""
SELECT CAST(substr(expense_id, 5) AS BIGINT) AS k, expense_date AS load_date,
  expense_id,
  strftime(expense_date, '%Y-%m-%d') AS expense_date,
  CASE WHEN CAST(substr(expense_id, 5) AS BIGINT) % 29 = 0 THEN 'CLOUD_INFRASTRUCTURE'
       WHEN CAST(substr(expense_id, 5) AS BIGINT) % 31 = 0 THEN 'TRAVEL'
       ELSE lower(expense_category) END AS expense_category,
  CASE WHEN CAST(substr(expense_id, 5) AS BIGINT) % 37 = 0 THEN 'GLOBAL' ELSE expense_scope END AS expense_scope,
  CASE WHEN CAST(substr(expense_id, 5) AS BIGINT) % 23 = 0 THEN '12.345' ELSE CAST(amount AS VARCHAR) END AS amount,
  'CAD' AS currency,
  CASE WHEN CAST(substr(expense_id, 5) AS BIGINT) % 41 = 0 AND expense_scope = 'POLICY' THEN 'CLM-000000001'
       ELSE claim_id END AS claim_id,
  CASE WHEN CAST(substr(expense_id, 5) AS BIGINT) % 43 = 0 AND expense_scope = 'CLAIM' THEN NULL
       ELSE policy_id END AS policy_id,
  CASE WHEN CAST(substr(expense_id, 5) AS BIGINT) % 47 = 0 AND expense_scope = 'CORPORATE' THEN 'ASIA'
       ELSE region END AS region,
  source_system,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S') || 'Z' AS created_at,
  strftime(updated_at, '%Y-%m-%dT%H:%M:%S') || 'Z' AS updated_at
FROM fx_expenses"""

_MONEY_RE = r"[+]?([0-9]+(\.[0-9]{0,2}0*)?|\.[0-9]{1,2}0*)"
_TS_RE = r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})"


def _line(cols: list[str]) -> str:
    return " || ',' || ".join(f"COALESCE({c}, '')" for c in cols)


def _iso(ts: str) -> str:
    return (f"CASE WHEN {ts} IS NOT NULL THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN strftime({ts}, '%f') <> '000000' THEN '.' || strftime({ts}, '%f') ELSE '' END || '+00:00' END")


V2_CUTOVER = "1999-01-01"
METHOD = ("CASE WHEN CAST(substr(claim_id, 5) AS BIGINT) % 61 = 0 THEN 'CASH' "
          "WHEN CAST(substr(claim_id, 5) AS BIGINT) % 3 = 0 THEN 'EFT' "
          "WHEN CAST(substr(claim_id, 5) AS BIGINT) % 3 = 1 THEN 'cheque' END")


def ledger_ctes(kind: str) -> str:
    """kind: payments, expenses, or payments_v2 (v1 layout before the
    cut-over date, v2 layout with payment_method from it on)."""
    v2 = kind == "payments_v2"
    payments = kind in ("payments", "payments_v2")
    fields = PAYMENT_FIELDS + (["payment_method"] if v2 else []) if payments else EXPENSE_FIELDS
    text = PAYMENT_TEXT if payments else EXPENSE_TEXT
    if v2:
        text = text.replace("FROM fx_payments", f", CASE WHEN payment_date >= DATE '{V2_CUTOVER}' THEN {METHOD} END "
                            "AS payment_method\nFROM fx_payments")
    prefix, dataset = ("claim-payments", "claim_payments") if payments else ("expense-transactions", "expense_transactions")
    date_field = "payment_date" if payments else "expense_date"
    id_field = "payment_id" if payments else "expense_id"
    upper = (["currency", "payment_type", "payee_type"] + (["payment_method"] if v2 else [])
             if payments else ["currency", "expense_category", "expense_scope"])
    required = [id_field, date_field, "amount", "currency", "source_system", "created_at", "updated_at"] + (
        ["claim_id", "policy_id", "payment_type", "payee_type", "source_event_id", "source_version"]
        if payments else ["expense_category", "expense_scope"])

    plus_one = "CAST(CAST(TRY_CAST(amount AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2)) AS VARCHAR)"

    def layout(make):
        if not v2:
            return make(fields)
        return (f"CASE WHEN load_date >= DATE '{V2_CUTOVER}' THEN {make(fields)} "
                f"ELSE {make(fields[:-1])} END")

    plain = layout(lambda fs: _line(fs))
    quoted = layout(lambda fs: _line([f"'\"' || {f} || '\"'" if f == "source_system" else f for f in fs]))
    resent = layout(lambda fs: _line([f"{f} || '0'" if f == "amount" else f for f in fs]))
    conflicting = layout(lambda fs: _line([plus_one if f == "amount" else f for f in fs]))
    field_list = ", ".join(fields)
    null_fields = ", ".join(f"NULL AS {f}" for f in fields)
    conflict_fields = ", ".join(plus_one + " AS amount" if f == "amount" else f for f in fields)

    norm = []
    for f in fields:
        e = f"NULLIF(trim({f}), '')"
        norm.append(f"upper({e}) AS {f}" if f in upper else f"{e} AS {f}")

    helpers = [
        f"CASE WHEN regexp_full_match(amount, '{_MONEY_RE}') AND TRY_CAST(amount AS DECIMAL(18,2)) > 0 "
        f"THEN TRY_CAST(amount AS DECIMAL(18,2)) END AS _amount",
        f"CASE WHEN regexp_full_match({date_field}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(try_strptime({date_field}, '%Y-%m-%d') AS DATE) END AS _txn_date",
    ]
    for k in ("created_at", "updated_at"):
        helpers.append(f"CASE WHEN regexp_full_match({k}, '{_TS_RE}') "
                       f"THEN timezone('UTC', TRY_CAST(replace({k}, 'Z', '+00:00') AS TIMESTAMPTZ)) END AS _{k}")
    if payments:
        helpers.append("CASE WHEN regexp_full_match(source_version, '[0-9]+') "
                       "AND TRY_CAST(source_version AS DECIMAL(38,0)) BETWEEN 1 AND 2147483647 "
                       "THEN CAST(source_version AS INTEGER) END AS _version")
    else:
        helpers.append("""CASE expense_category
            WHEN 'CLAIM_ADJUSTING' THEN 'CLAIM' WHEN 'CLAIM_SETTLEMENT_ADMIN' THEN 'CLAIM'
            WHEN 'POLICY_INSPECTION' THEN 'POLICY' WHEN 'BROKER_COMMISSION' THEN 'POLICY'
            WHEN 'REGIONAL_MARKETING' THEN 'PORTFOLIO' WHEN 'CLOUD_INFRASTRUCTURE' THEN 'CORPORATE'
            WHEN 'FINANCE_HR_PAYROLL' THEN 'CORPORATE' WHEN 'OFFICE_RENT' THEN 'CORPORATE' END AS _mapped_scope""")

    rules = [f"CASE WHEN {k} IS NULL THEN '{k} is missing' END" for k in required]
    rules += [
        "CASE WHEN currency IS NOT NULL AND NOT regexp_full_match(currency, '[A-Z]{3}') "
        "THEN 'currency must be a three-letter code' END",
        "CASE WHEN claim_id IS NOT NULL AND NOT regexp_full_match(claim_id, 'CLM-[0-9]+') THEN 'claim_id has invalid format' END",
        "CASE WHEN policy_id IS NOT NULL AND NOT regexp_full_match(policy_id, 'POL-[0-9]+') THEN 'policy_id has invalid format' END",
        "CASE WHEN _amount IS NULL THEN 'amount must be positive decimal(18,2), without rounding' END",
        f"CASE WHEN _txn_date IS NULL THEN '{date_field} is invalid' END",
        f"CASE WHEN _txn_date > load_date THEN '{date_field} is after process date' END",
    ]
    for k in ("created_at", "updated_at"):
        rules += [f"CASE WHEN _{k} IS NULL THEN '{k} must be an ISO timestamp with timezone' END",
                  f"CASE WHEN CAST(_{k} AS DATE) > load_date THEN '{k} is after process date' END"]
    rules += ["CASE WHEN _updated_at < _created_at THEN 'updated_at is before created_at' END",
              "CASE WHEN CAST(_created_at AS DATE) < _txn_date THEN 'created_at is before transaction date' END"]
    if payments:
        rules += [
            "CASE WHEN payment_type IS NULL OR payment_type NOT IN ('INDEMNITY') THEN 'payment_type is unsupported' END",
            "CASE WHEN payee_type IS NULL OR payee_type NOT IN ('CLAIMANT', 'REPAIR_SHOP', 'RENTAL_PROVIDER', "
            "'MEDICAL_PROVIDER', 'GLASS_REPAIR_VENDOR') THEN 'payee_type is invalid' END",
            "CASE WHEN _version IS NULL THEN 'source_version must be a positive integer' END",
        ]
        if v2:
            rules.append("CASE WHEN payment_method IS NOT NULL AND payment_method NOT IN ('EFT', 'CHEQUE') "
                         "THEN 'payment_method is invalid' END")
    else:
        rules += [
            "CASE WHEN expense_scope IS NULL OR expense_scope NOT IN ('CLAIM', 'POLICY', 'PORTFOLIO', 'CORPORATE') "
            "THEN 'expense_scope is invalid' END",
            "CASE WHEN _mapped_scope IS NULL THEN 'expense_category is unsupported' END",
            "CASE WHEN _mapped_scope IS NOT NULL AND (expense_scope IS NULL OR _mapped_scope <> expense_scope) "
            "THEN 'expense_category does not match expense_scope' END",
            "CASE WHEN expense_scope = 'CLAIM' AND (claim_id IS NULL OR policy_id IS NULL) "
            "THEN 'CLAIM expense requires claim_id and policy_id' END",
            "CASE WHEN expense_scope = 'POLICY' AND (policy_id IS NULL OR claim_id IS NOT NULL) "
            "THEN 'POLICY expense requires policy_id and null claim_id' END",
            "CASE WHEN expense_scope IN ('PORTFOLIO', 'CORPORATE') AND (claim_id IS NOT NULL OR policy_id IS NOT NULL) "
            "THEN 'overhead must not reference a claim or policy' END",
            "CASE WHEN expense_scope = 'CORPORATE' AND region IS NOT NULL "
            "THEN 'CORPORATE expense must have null region' END",
        ]

    out = []
    for f in fields:
        if f == "amount":
            out.append("CAST(_amount AS VARCHAR) AS amount")
        elif f == date_field:
            out.append(f"CASE WHEN _txn_date IS NOT NULL THEN {f} END AS {f}")
        elif f in ("created_at", "updated_at"):
            out.append(f"{_iso('_' + f)} AS {f}")
        elif f == "source_version":
            out.append("CAST(_version AS VARCHAR) AS source_version")
        else:
            out.append(f)
    typed = []
    for f in fields:
        if f == "amount":
            typed.append("CAST(amount AS DECIMAL(18,2)) AS amount")
        elif f == date_field:
            typed.append(f"CAST({f} AS DATE) AS {f}")
        elif f in ("created_at", "updated_at"):
            typed.append(f"timezone('UTC', CAST({f} AS TIMESTAMPTZ)) AS {f}")
        elif f == "source_version":
            typed.append("CAST(source_version AS INTEGER) AS source_version")
        else:
            typed.append(f)
    partition = ", ".join(["load_date"] + fields)
    src = f"'bronze/{prefix}/{dataset}_' || strftime(load_date, '%Y-%m-%d') || '.csv'"

    return f"""
l_text AS ({text}),
l_lines AS (
  SELECT CASE WHEN k % 13 = 0 THEN {plain} || ',EXTRA'
              WHEN k % 19 = 0 THEN '"' || {plain}
              WHEN k % 7 = 0 THEN {quoted}
              ELSE {plain} END AS raw_record,
         load_date,
         CASE WHEN k % 13 = 0 THEN 'malformed CSV: wrong CSV field count'
              WHEN k % 19 = 0 THEN 'malformed CSV: unexpected end of data' END AS _parse_error,
         {field_list}
  FROM l_text
  UNION ALL
  SELECT {resent}, load_date, NULL, {", ".join(f"{f} || '0' AS {f}" if f == "amount" else f for f in fields)}
  FROM l_text WHERE k % 5 = 0
  UNION ALL
  SELECT {conflicting}, load_date, NULL, {conflict_fields}
  FROM l_text WHERE k % 11 = 0
),
l_parsed AS (
  SELECT raw_record, {src} AS source_file, load_date, _parse_error, {", ".join(f"CASE WHEN _parse_error IS NULL THEN {f} END AS {f}" for f in fields)}
  FROM l_lines
),
l_norm AS (SELECT raw_record, source_file, load_date, _parse_error, {", ".join(norm)} FROM l_parsed),
l_help AS (SELECT *, {", ".join(helpers)} FROM l_norm),
l_rules AS (SELECT *, concat_ws('; ', {", ".join(rules)}) AS _rule_errors FROM l_help),
l_checked AS (
  SELECT raw_record, source_file, {", ".join(out)},
         CASE WHEN _parse_error IS NULL THEN _rule_errors ELSE _parse_error || '; ' || _rule_errors END AS dq_errors,
         load_date
  FROM l_rules
),
l_unique AS (
  SELECT * EXCLUDE (rn), count(*) OVER (PARTITION BY load_date, {id_field}) AS id_count
  FROM (SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY raw_record, source_file) AS rn,
               count(*) OVER (PARTITION BY {partition}) AS copies
        FROM l_checked WHERE dq_errors = '')
  WHERE rn = 1
),
l_quarantine AS (
  SELECT raw_record, source_file, {field_list}, dq_errors, load_date FROM l_checked WHERE dq_errors <> ''
  UNION ALL
  SELECT raw_record, source_file, {field_list}, 'conflicting transaction ID within load date', load_date
  FROM l_unique WHERE id_count > 1
),
l_valid AS (
  SELECT source_file, {", ".join(typed)}, load_date FROM l_unique WHERE id_count = 1
),
l_metrics AS (
  SELECT '{dataset}' AS dataset, load_date,
         CAST(sum(invalid) + sum(copies) AS BIGINT) AS input_rows,
         CAST(sum(valid) AS BIGINT) AS valid_rows,
         CAST(sum(invalid) + sum(conflict) AS BIGINT) AS quarantine_rows,
         CAST(sum(copies) - sum(uniq) AS BIGINT) AS duplicate_rows_collapsed
  FROM (SELECT load_date, 1 AS invalid, 0 AS copies, 0 AS uniq, 0 AS valid, 0 AS conflict
        FROM l_checked WHERE dq_errors <> ''
        UNION ALL
        SELECT load_date, 0, copies, 1, CASE WHEN id_count = 1 THEN 1 ELSE 0 END,
               CASE WHEN id_count > 1 THEN 1 ELSE 0 END
        FROM l_unique)
  GROUP BY load_date
)"""


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",".join([FIXTURE_CTES, *ctes]) + "\n" + body


ORACLES: dict[str, str] = {
    "claims_dq_split": _with(CLAIMS_CTES, body=CLAIMS_DQ),
    "claims_silver": _with(CLAIMS_CTES, body=CLAIMS_SILVER),
    "exposure_dq_split": _with(EXPOSURE_CTES, body=EXPOSURE_DQ),
    "payments_dq": _with(ledger_ctes("payments"), body="SELECT * FROM l_quarantine"),
    "payments_silver": _with(ledger_ctes("payments"), body="SELECT * FROM l_valid"),
    "payments_load_metrics": _with(ledger_ctes("payments"), body="SELECT * FROM l_metrics"),
    "expenses_dq_scope": _with(ledger_ctes("expenses"), body="SELECT * FROM l_quarantine"),
    "expenses_silver": _with(ledger_ctes("expenses"), body="SELECT * FROM l_valid"),
    "payments_v2_union": _with(ledger_ctes("payments_v2"), body="SELECT * FROM l_valid"),
}


def _totals() -> str:
    """All rows of each feed: which went where, counted from the checked rows."""
    ledgers = [f"""
SELECT dataset, CAST(sum(input_rows) AS BIGINT) AS input_rows, CAST(sum(valid_rows) AS BIGINT) AS valid_rows,
       CAST(sum(quarantine_rows) AS BIGINT) AS quarantine_rows, CAST(sum(duplicate_rows_collapsed) AS BIGINT) AS duplicate_rows_collapsed
FROM ({ORACLES_OF_LEDGER[kind]}) GROUP BY dataset""" for kind in ("payments", "expenses")]
    claims = f"""
SELECT 'claims_events' AS dataset, count(*) AS input_rows,
       count(DISTINCT (load_date, event_id)) FILTER (dq_errors = '') AS valid_rows, count(*) FILTER (dq_errors <> '') AS quarantine_rows,
       count(*) FILTER (dq_errors = '') - count(DISTINCT (load_date, event_id)) FILTER (dq_errors = '') AS duplicate_rows_collapsed
FROM ({ORACLES["claims_dq_split"]})"""
    exposure = f"""
SELECT 'daily_exposure' AS dataset, count(*) AS input_rows, count(*) FILTER (dq_errors = '') AS valid_rows,
       count(*) FILTER (dq_errors <> '') AS quarantine_rows, CAST(0 AS BIGINT) AS duplicate_rows_collapsed
FROM ({ORACLES["exposure_dq_split"]})"""
    return " UNION ALL ".join([*ledgers, claims, exposure])


ORACLES_OF_LEDGER = {kind: _with(ledger_ctes(kind), body="SELECT * FROM l_metrics") for kind in ("payments", "expenses")}
ORACLES.update({
    "load_metrics": _totals(),
    "claims_quarantine": f"SELECT * FROM ({ORACLES['claims_dq_split']}) WHERE dq_errors <> ''",
    "exposure_quarantine": f"SELECT * FROM ({ORACLES['exposure_dq_split']}) WHERE dq_errors <> ''",
    "exposure_silver": f"SELECT * EXCLUDE (dq_errors) FROM ({ORACLES['exposure_dq_split']}) WHERE dq_errors = ''",
})
