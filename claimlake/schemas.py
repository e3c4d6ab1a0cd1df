"""Feed contracts, business field lists and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's contracts for identical results)
# ---------------------------------------------------------------------------
CLAIM_EVENT_FIELDS = [
    "event_id", "claim_id", "policy_id", "operation", "source_version",
    "source_updated_at", "incident_date", "reported_date", "arrival_timestamp",
    "incident_type", "claim_status", "incurred_amount", "paid_amount",
    "police_reported", "fraud_score", "manual_review_required",
]
EXPOSURE_FEED_FIELDS = [
    "exposure_record_id", "policy_id", "region", "customer_segment", "age_band",
    "earned_exposure", "earned_premium", "annual_premium",
]
PAYMENT_FIELDS = [
    "payment_id", "claim_id", "policy_id", "payment_date", "payment_type",
    "payee_type", "amount", "currency", "source_event_id", "source_version",
    "source_system", "created_at", "updated_at",
]
PAYMENT_V2_FIELDS = PAYMENT_FIELDS + ["payment_method"]
EXPENSE_FIELDS = [
    "expense_id", "expense_date", "expense_category", "expense_scope", "amount",
    "currency", "claim_id", "policy_id", "region", "source_system", "created_at",
    "updated_at",
]
POLICY_CHANGE_FIELDS = [
    "policy_change_id", "policy_id", "operation", "source_version", "effective_date",
    "change_type", "old_coverage_type", "new_coverage_type", "old_annual_premium",
    "new_annual_premium", "source_system", "source_updated_at",
]

# Business columns Gold keeps before exact-duplicate collapse.
GOLD_CLAIM_FIELDS = [
    "claim_id", "policy_id", "source_version", "source_updated_at", "incident_date",
    "reported_date", "operation", "claim_status", "incurred_amount", "paid_amount",
]
GOLD_EXPOSURE_FIELDS = [
    "policy_id", "load_date", "region", "customer_segment", "age_band",
    "earned_exposure", "earned_premium",
]
# The IBNR job resolves claims on fewer columns than Gold.
IBNR_CLAIM_FIELDS = [
    "claim_id", "policy_id", "source_version", "source_updated_at", "incident_date",
    "reported_date", "operation", "incurred_amount",
]

CLAIM_OPERATIONS = ["INSERT", "UPDATE", "DELETE"]
GOLD_CLAIM_OPERATIONS = ["INSERT", "UPDATE"]
POLICE_REPORTED_VALUES = ["Y", "N", "UNKNOWN"]
TRUE_TOKENS = ["TRUE", "Y", "1"]
FALSE_TOKENS = ["FALSE", "N", "0"]
PAYMENT_TYPES = ["INDEMNITY"]
PAYEE_TYPES = ["CLAIMANT", "REPAIR_SHOP", "RENTAL_PROVIDER", "MEDICAL_PROVIDER", "GLASS_REPAIR_VENDOR"]
EXPENSE_SCOPES = ["CLAIM", "POLICY", "PORTFOLIO", "CORPORATE"]
EXPENSE_CATEGORY_SCOPE = {
    "CLAIM_ADJUSTING": "CLAIM",
    "CLAIM_SETTLEMENT_ADMIN": "CLAIM",
    "POLICY_INSPECTION": "POLICY",
    "BROKER_COMMISSION": "POLICY",
    "REGIONAL_MARKETING": "PORTFOLIO",
    "CLOUD_INFRASTRUCTURE": "CORPORATE",
    "FINANCE_HR_PAYROLL": "CORPORATE",
    "OFFICE_RENT": "CORPORATE",
}
UNKNOWN_REGION_TOKEN = "UNKNOWN_REGION"
POLICY_CHANGE_OPERATIONS = ["INSERT", "UPDATE"]
GOLD_CURRENCY = "CAD"
BF_MODEL_METHOD = "BF_REPORTED_INCURRED"
GOLD_TABLES = ("claim_snapshot", "policy_performance", "portfolio_performance", "expense_summary")
SILVER_DATASETS = ("claims_events", "daily_exposure", "claim_payments", "expense_transactions")
# ---------------------------------------------------------------------------

MONEY = T.DecimalType(18, 2)
EXPOSURE = T.DecimalType(18, 8)
PREMIUM = T.DecimalType(18, 4)
GOLD_MONEY = T.DecimalType(28, 4)
GOLD_EXPOSURE = T.DecimalType(28, 8)
RATE = T.DecimalType(18, 8)


def all_strings(fields: list[str]) -> T.StructType:
    """Bronze schema: every column text, so bad values survive the scan."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in fields])


class LedgerContract:
    """Shape of an immutable transaction feed (payments or expenses)."""

    def __init__(self, dataset: str, fields: list[str], id_field: str, date_field: str,
                 required: list[str], upper_fields: list[str], kind: str,
                 payment_methods: tuple[str, ...] | None = None):
        self.dataset = dataset
        self.fields = fields
        self.id_field = id_field
        self.date_field = date_field
        self.required = required
        self.upper_fields = upper_fields
        self.kind = kind
        self.payment_methods = payment_methods

    @property
    def prefix(self) -> str:
        return self.dataset.replace("_", "-")


_LEDGER_REQUIRED = ["amount", "currency", "source_system", "created_at", "updated_at"]

PAYMENTS = LedgerContract(
    "claim_payments", PAYMENT_FIELDS, "payment_id", "payment_date",
    ["payment_id", "payment_date"] + _LEDGER_REQUIRED
    + ["claim_id", "policy_id", "payment_type", "payee_type", "source_event_id", "source_version"],
    ["currency", "payment_type", "payee_type"], "payments",
)
EXPENSES = LedgerContract(
    "expense_transactions", EXPENSE_FIELDS, "expense_id", "expense_date",
    ["expense_id", "expense_date"] + _LEDGER_REQUIRED + ["expense_category", "expense_scope"],
    ["currency", "expense_category", "expense_scope"], "expenses",
)


def payments_v2(methods: tuple[str, ...]) -> LedgerContract:
    """Payments contract v2: v1 plus a nullable ``payment_method`` from an allowed list."""
    return LedgerContract(
        "claim_payments", PAYMENT_V2_FIELDS, "payment_id", "payment_date",
        PAYMENTS.required, PAYMENTS.upper_fields + ["payment_method"], "payments",
        payment_methods=tuple(methods),
    )


def _typed(fields: list[str], types: dict[str, T.DataType], more: list[str]) -> T.StructType:
    """The Silver columns of a feed in file order, all nullable; a field without a type of its own is text."""
    return T.StructType([T.StructField(name, types.get(name, T.StringType()), True) for name in fields + more])


_SILVER_TYPES = {
    "source_version": T.IntegerType(), "fraud_score": T.IntegerType(), "manual_review_required": T.BooleanType(),
    "earned_exposure": EXPOSURE, "earned_premium": PREMIUM,
    **{name: MONEY for name in ("incurred_amount", "paid_amount", "annual_premium", "amount")},
    **{name: T.DateType() for name in ("incident_date", "reported_date", "payment_date", "expense_date", "load_date")},
    **{name: T.TimestampType() for name in ("source_updated_at", "arrival_timestamp", "created_at", "updated_at", "silver_processed_at")},
}
_LOADED = ["source_file", "silver_processed_at"]

#: What the Silver loads write, per dataset, with ``load_date`` from the folder.  Payments have the
#: newest contract: a day loaded under the first one reads as null in the columns added since.
SILVER_SCHEMAS = {
    "claims_events": _typed(CLAIM_EVENT_FIELDS, _SILVER_TYPES, _LOADED + ["load_date"]),
    "daily_exposure": _typed(EXPOSURE_FEED_FIELDS, _SILVER_TYPES, _LOADED + ["region_quality_flag", "load_date"]),
    "claim_payments": _typed(PAYMENT_V2_FIELDS, _SILVER_TYPES, _LOADED + ["load_date"]),
    "expense_transactions": _typed(EXPENSE_FIELDS, _SILVER_TYPES, _LOADED + ["load_date"]),
}
