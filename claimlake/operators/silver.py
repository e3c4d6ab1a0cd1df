"""Bronze -> Silver loads: type, validate, quarantine, de-duplicate.

Every operator takes the Bronze rows of one or more load dates (a
``load_date`` column holds the file's processing date) and returns a
:class:`SilverResult`.  All per-file rules -- event de-duplication,
duplicate-id counts, conflicting transaction ids -- are keyed by
``(load_date, key)``, so a single day reproduces the per-file job exactly
and a multi-day backfill runs as one job without mixing days.

Scale notes
* Counting rows per key uses an aggregation joined back on the key instead
  of a window count: the aggregation combines map-side and AQE splits the
  join partition of a hot key, where a window would pull every row of that
  key into one task.
* Picking one row per key is ``max_by``/``min`` over a struct: partial
  aggregation keeps a single candidate per key per map task.
* The ledger feeds are parsed with native regular expressions and
  ``from_csv``; no Python runs per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.plan import evaluated_once
from ..functions.rules import Rule, SEPARATOR, error_list, is_invalid, is_valid, missing, not_in
from ..schemas import (
    CLAIM_EVENT_FIELDS, CLAIM_OPERATIONS, EXPENSE_CATEGORY_SCOPE, EXPENSE_SCOPES, EXPOSURE, MONEY,
    PAYEE_TYPES, PAYMENT_TYPES, POLICE_REPORTED_VALUES, PREMIUM, UNKNOWN_REGION_TOKEN, LedgerContract,
)
from ..session import staged


@dataclass
class SilverResult:
    valid: DataFrame
    quarantine: DataFrame
    metrics: DataFrame | None = None
    #: filled by the write of ``valid`` itself: input_rows, invalid_rows, duplicate_rows_collapsed
    observations: list[Observation] = field(default_factory=list)


def _observed(df: DataFrame, into: list[Observation], **measures: Column) -> DataFrame:
    """``df``, measured by whatever action runs it."""
    into.append(Observation())
    return df.observe(into[-1], *[F.coalesce(m, F.lit(0)).cast("bigint").alias(name) for name, m in measures.items()])


def _input_measures() -> dict[str, Column]:
    return {"input_rows": F.count(F.lit(1)), "invalid_rows": F.count_if(is_invalid())}


def count_by(df: DataFrame, keys: list[str], name: str, over: DataFrame | None = None) -> DataFrame:
    """Attach the number of rows of ``over`` (else of ``df``) that share ``keys`` (NULL keys
    form one group, as a window partition would)."""
    own = [f"_{name}_{k}" for k in keys]
    counts = (over or df).groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)]).agg(F.count(F.lit(1)).alias(name))
    cond = reduce(Column.__and__, [df[k].eqNullSafe(counts[o]) for k, o in zip(keys, own)])
    return df.join(counts, cond, "left").drop(*own)


# ---------------------------------------------------------------------------
# C1 claim events
# ---------------------------------------------------------------------------

def typed_claims(raw: DataFrame) -> DataFrame:
    t = clean.trimmed
    return raw.select(
        t("event_id").alias("event_id"),
        t("claim_id").alias("claim_id"),
        t("policy_id").alias("policy_id"),
        F.upper(t("operation")).alias("operation"),
        t("source_version").try_cast("int").alias("source_version"),
        clean.offset_timestamp(t("source_updated_at")).alias("source_updated_at"),
        clean.strict_date(t("incident_date")).alias("incident_date"),
        clean.strict_date(t("reported_date")).alias("reported_date"),
        clean.offset_timestamp(t("arrival_timestamp")).alias("arrival_timestamp"),
        t("incident_type").alias("incident_type"),
        F.upper(t("claim_status")).alias("claim_status"),
        t("incurred_amount").try_cast(MONEY).alias("incurred_amount"),
        t("paid_amount").try_cast(MONEY).alias("paid_amount"),
        F.upper(t("police_reported")).alias("police_reported"),
        t("fraud_score").try_cast("int").alias("fraud_score"),
        clean.tri_state("manual_review_required").alias("manual_review_required"),
        F.col("source_file"),
        F.col("load_date"),
        F.current_timestamp().alias("silver_processed_at"),
    )


def claim_rules() -> list[Rule]:
    c = F.col
    return [
        ("event_id is missing", missing("event_id")),
        ("claim_id is missing", missing("claim_id")),
        ("policy_id is missing", missing("policy_id")),
        ("operation is missing", c("operation").isNull()),
        ("operation is invalid", c("operation").isNotNull() & ~c("operation").isin(*CLAIM_OPERATIONS)),
        ("source_version is invalid", c("source_version").isNull() | (c("source_version") <= 0)),
        ("source_updated_at is invalid", c("source_updated_at").isNull()),
        ("incident_date is invalid", c("incident_date").isNull()),
        ("reported_date is invalid", c("reported_date").isNull()),
        ("reported_date is before incident_date", c("reported_date") < c("incident_date")),
        ("arrival_timestamp is invalid", c("arrival_timestamp").isNull()),
        ("incident_type is missing", missing("incident_type")),
        ("claim_status is missing", missing("claim_status")),
        ("incurred_amount is invalid", c("incurred_amount").isNull() | (c("incurred_amount") < 0)),
        ("paid_amount is invalid", c("paid_amount").isNull() | (c("paid_amount") < 0)),
        ("police_reported is invalid", not_in("police_reported", POLICE_REPORTED_VALUES)),
        ("fraud_score is invalid",
         c("fraud_score").isNull() | (c("fraud_score") < 0) | (c("fraud_score") > 100)),
        ("manual_review_required is invalid", c("manual_review_required").isNull()),
    ]


def checked_claims(raw: DataFrame) -> DataFrame:
    """Typed events + dq_errors.  Both steps end at a generator boundary so
    the valid/invalid filters read a computed column instead of re-running
    every rule (and every parse) inside the filter."""
    typed = evaluated_once(typed_claims(raw))
    return evaluated_once(typed.withColumn("dq_errors", error_list(claim_rules())))


CLAIM_SILVER_COLUMNS = CLAIM_EVENT_FIELDS + ["source_file", "silver_processed_at"]


def silver_claims(raw: DataFrame) -> SilverResult:
    """Typed claim events; one row per (load_date, event_id) with the highest
    source_version, then the latest update.  Remaining ties are broken by a
    total order over the row (source_file first) so reruns are stable."""
    checked, seen = checked_claims(raw), []
    valid = _observed(checked, seen, **_input_measures()).filter(is_valid())
    # the order holds every column, so the greatest struct is the row itself and travels once
    first = ["source_version", "source_updated_at", "source_file"]
    ordered = F.struct(*first, *[c for c in CLAIM_SILVER_COLUMNS if c not in ("event_id", *first)])
    deduped = (
        valid.groupBy("load_date", "event_id")
        .agg(F.max(ordered).alias("_row"), F.count(F.lit(1)).alias("_copies"))
        .select("load_date", "event_id", "_copies", "_row.*")
    )
    deduped = _observed(deduped, seen, duplicate_rows_collapsed=F.sum(F.col("_copies") - 1))
    quarantine = checked.filter(is_invalid())
    return SilverResult(deduped.select(*CLAIM_SILVER_COLUMNS, "load_date"),
                        quarantine.select(*CLAIM_SILVER_COLUMNS, "dq_errors", "load_date"), observations=seen)


# ---------------------------------------------------------------------------
# C2 daily exposure
# ---------------------------------------------------------------------------

EXPOSURE_SILVER_COLUMNS = [
    "exposure_record_id", "policy_id", "region", "customer_segment", "age_band", "earned_exposure",
    "earned_premium", "annual_premium", "source_file", "silver_processed_at", "region_quality_flag",
]


def typed_exposure(raw: DataFrame) -> DataFrame:
    t = clean.trimmed
    return raw.select(
        t("exposure_record_id").alias("exposure_record_id"),
        t("policy_id").alias("policy_id"),
        t("region").alias("region"),
        t("customer_segment").alias("customer_segment"),
        t("age_band").alias("age_band"),
        t("earned_exposure").try_cast(EXPOSURE).alias("earned_exposure"),
        t("earned_premium").try_cast(PREMIUM).alias("earned_premium"),
        t("annual_premium").try_cast(MONEY).alias("annual_premium"),
        F.col("source_file"),
        F.col("load_date"),
        F.current_timestamp().alias("silver_processed_at"),
    )


def exposure_rules() -> list[Rule]:
    c = F.col
    return [
        ("exposure_record_id is missing", missing("exposure_record_id")),
        ("policy_id is missing", missing("policy_id")),
        ("region is missing", missing("region")),
        ("customer_segment is missing", missing("customer_segment")),
        ("age_band is missing", missing("age_band")),
        ("earned_exposure is invalid", c("earned_exposure").isNull()),
        ("earned_exposure is outside the expected range",
         (c("earned_exposure") < 0) | (c("earned_exposure") > 1)),
        ("earned_premium is invalid", c("earned_premium").isNull() | (c("earned_premium") < 0)),
        ("annual_premium is invalid", c("annual_premium").isNull() | (c("annual_premium") < 0)),
        ("duplicate exposure_record_id", c("_exposure_id_count") > 1),
        ("duplicate policy_id for processing date", c("_policy_count") > 1),
    ]


def checked_exposure(raw: DataFrame) -> DataFrame:
    """Counts are taken before validity is known: an invalid twin also
    condemns a valid row, and every copy of a duplicate is quarantined."""
    typed = evaluated_once(typed_exposure(raw))
    feed = typed  # both counts are taken from the typed feed's keys, not from each other's join
    typed = count_by(feed, ["load_date", "exposure_record_id"], "_exposure_id_count")
    typed = count_by(typed, ["load_date", "policy_id"], "_policy_count", over=feed)
    typed = typed.withColumn(
        "region_quality_flag",
        F.when(F.upper(F.col("region")) == UNKNOWN_REGION_TOKEN, F.lit("UNKNOWN")).otherwise(F.lit("VALID")))
    return evaluated_once(typed.withColumn("dq_errors", error_list(exposure_rules())))


def silver_exposure(raw: DataFrame) -> SilverResult:
    checked, seen = checked_exposure(raw), []
    return SilverResult(
        _observed(checked, seen, **_input_measures()).filter(is_valid()).select(*EXPOSURE_SILVER_COLUMNS, "load_date"),
        checked.filter(is_invalid()).select(*EXPOSURE_SILVER_COLUMNS, "dq_errors", "load_date"), observations=seen,
    )


# ---------------------------------------------------------------------------
# C3/C4 ledgers (payments, expenses)
# ---------------------------------------------------------------------------

# Possessive throughout: the matcher walks a line of any length without recursion.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:{_QUOTED}"|(?!")[^,]*+)'
_ANY_FIELDS = rf"^{_FIELD}(?:,{_FIELD})*+$"
_OPEN_QUOTE = rf"^(?:{_FIELD},)*+{_QUOTED}$"


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^\\x{FEFF}", "")


def csv_line_error(value: Column, n_fields: int) -> Column:
    """NULL for a strictly quoted line with exactly ``n_fields`` fields, else
    the malformed-CSV reason."""
    exact = rf"^{_FIELD}(?:,{_FIELD}){{{n_fields - 1}}}+$"
    return (
        F.when(value.rlike(exact), F.lit(None).cast("string"))
        .when(value.rlike(_ANY_FIELDS), F.lit("malformed CSV: wrong CSV field count"))
        .when(value.rlike(_OPEN_QUOTE), F.lit("malformed CSV: unexpected end of data"))
        .otherwise(F.lit("malformed CSV: ',' expected after '\"'"))
    )


def parse_ledger_lines(lines: DataFrame, contract: LedgerContract) -> DataFrame:
    """(value, source_file, load_date) text lines -> raw_record, the fields as
    text (NULL when the line is malformed) and the parse error.

    The fields leave through a generator (``inline``).  Filters on the
    validation result are then evaluated above it instead of being rewritten,
    alias by alias, into dozens of copies of the CSV parse of the raw line
    (which made the optimized plan grow multiplicatively)."""
    fields = contract.fields
    schema = ", ".join(f"`{f}` STRING" for f in fields)
    parsed = F.from_csv(F.col("value"), schema, {"escape": '"', "mode": "PERMISSIVE"})
    # the error leaves through a generator of its own: its patterns run once per line
    judged = evaluated_once(lines.select(
        "value", "source_file", "load_date", csv_line_error(F.col("value"), len(fields)).alias("_parse_error")))
    raw = judged.select("*", F.when(F.col("_parse_error").isNull(), parsed).alias("_parsed"))
    row = F.struct(F.col("_parse_error"), *[F.col(f"_parsed.`{f}`").alias(f) for f in fields])
    return raw.select(
        F.col("value").alias("raw_record"), "source_file", "load_date", F.inline(F.array(row)),
    )


def _ledger_rules(contract: LedgerContract) -> list[Rule]:
    """Rules in the feed's order, over the staged helper columns."""
    c = F.col
    pd = c("load_date")
    date_field = contract.date_field
    rules: list[Rule] = [(f"{k} is missing", c(k).isNull()) for k in contract.required]
    rules.append(("currency must be a three-letter code", c("currency").isNotNull() & ~c("currency").rlike("^[A-Z]{3}$")))
    for key, pattern in [("claim_id", "^CLM-[0-9]+$"), ("policy_id", "^POL-[0-9]+$")]:
        rules.append((f"{key} has invalid format", c(key).isNotNull() & ~c(key).rlike(pattern)))
    rules.append(("amount must be positive decimal(18,2), without rounding", c("_amount").isNull()))
    rules.append((f"{date_field} is invalid", c("_txn_date").isNull()))
    rules.append((f"{date_field} is after process date", c("_txn_date") > pd))
    for key in ("created_at", "updated_at"):
        rules.append((f"{key} must be an ISO timestamp with timezone", c(f"_{key}").isNull()))
        rules.append((f"{key} is after process date", F.to_date(c(f"_{key}")) > pd))
    rules.append(("updated_at is before created_at", c("_updated_at") < c("_created_at")))
    rules.append(("created_at is before transaction date", F.to_date(c("_created_at")) < c("_txn_date")))
    if contract.kind == "payments":
        rules.append(("payment_type is unsupported", not_in("payment_type", PAYMENT_TYPES)))
        rules.append(("payee_type is invalid", not_in("payee_type", PAYEE_TYPES)))
        rules.append(("source_version must be a positive integer", c("_version").isNull()))
        if contract.payment_methods is not None:
            rules.append(("payment_method is invalid",
                          c("payment_method").isNotNull() & ~c("payment_method").isin(*contract.payment_methods)))
    else:
        scope, mapped = c("expense_scope"), c("_mapped_scope")
        rules += [
            ("expense_scope is invalid", not_in("expense_scope", EXPENSE_SCOPES)),
            ("expense_category is unsupported", mapped.isNull()),
            ("expense_category does not match expense_scope",
             mapped.isNotNull() & (scope.isNull() | (mapped != scope))),
            ("CLAIM expense requires claim_id and policy_id",
             (scope == "CLAIM") & (c("claim_id").isNull() | c("policy_id").isNull())),
            ("POLICY expense requires policy_id and null claim_id",
             (scope == "POLICY") & (c("policy_id").isNull() | c("claim_id").isNotNull())),
            ("overhead must not reference a claim or policy",
             scope.isin("PORTFOLIO", "CORPORATE") & (c("claim_id").isNotNull() | c("policy_id").isNotNull())),
            ("CORPORATE expense must have null region", (scope == "CORPORATE") & c("region").isNotNull()),
        ]
    return rules


def _category_scope(category: Column) -> Column:
    out = None
    for cat, scope in EXPENSE_CATEGORY_SCOPE.items():
        out = F.when(category == cat, scope) if out is None else out.when(category == cat, scope)
    return out


def checked_ledger(parsed: DataFrame, contract: LedgerContract) -> DataFrame:
    """Normalised text fields plus dq_errors, in the feed's rule order.

    Three projections: (1) strip / blank-to-NULL / upper-case the text,
    (2) derive the typed helpers once, (3) evaluate the rules over plain
    columns.  Each value is computed once per row and the generated code
    stays small."""
    fields = contract.fields
    keep = ["raw_record", "source_file", "load_date", "_parse_error"]
    norm = {f: clean.stripped_or_null(F.col(f)) for f in fields}
    for f in contract.upper_fields:
        norm[f] = F.upper(norm[f])
    stage1 = parsed.select(*keep, *[norm[f].alias(f) for f in fields])

    date_text = F.col(contract.date_field)
    helpers = [
        clean.exact_money(F.col("amount")).alias("_amount"),
        F.when(date_text.rlike(clean.ISO_DATE), clean.strict_date(date_text)).alias("_txn_date"),
        clean.zoned_timestamp(F.col("created_at")).alias("_created_at"),
        clean.zoned_timestamp(F.col("updated_at")).alias("_updated_at"),
    ]
    if "source_version" in fields:
        helpers.append(clean.positive_int_text(F.col("source_version")).alias("_version"))
    if contract.kind == "expenses":
        helpers.append(_category_scope(F.col("expense_category")).alias("_mapped_scope"))
    stage2 = evaluated_once(stage1.select("*", *helpers))

    out = {f: F.col(f) for f in fields}
    out["amount"] = F.col("_amount").cast("string")
    out[contract.date_field] = F.when(F.col("_txn_date").isNotNull(), date_text)
    for k in ("created_at", "updated_at"):
        out[k] = clean.iso_utc_text(F.col(f"_{k}"))
    if "source_version" in fields:
        out["source_version"] = F.col("_version").cast("string")
    dq = F.concat_ws(SEPARATOR, "_parse_error", error_list(_ledger_rules(contract)))  # a malformed line fails rules too
    return stage2.select(
        "raw_record", "source_file", *[out[f].alias(f) for f in fields],
        dq.alias("dq_errors"), F.current_timestamp().alias("silver_processed_at"), "load_date",
    )


def silver_ledger(lines: DataFrame, contract: LedgerContract, header: str | None = None) -> SilverResult:
    """Immutable transaction feed -> valid rows, quarantine, load metrics.

    ``lines`` holds (value, source_file, load_date).  A leading BOM is
    removed from every line and lines equal to the header are dropped.
    Identical normalised rows collapse to one representative (smallest raw
    text, then file); distinct rows sharing an id within a load date are all
    quarantined as conflicting."""
    header = header if header is not None else ",".join(contract.fields)
    body = evaluated_once(lines.withColumn("value", strip_bom(F.col("value")))).filter(F.col("value") != F.lit(header))
    # Staged, as the three consumers (invalid rows, candidates, metrics) share the parse.
    # The files are also a leaf for the optimizer: without them, constraint inference over
    # the wide rule expressions explodes once the id counts are joined back.
    seen: list[Observation] = []
    checked = staged(_observed(checked_ledger(parse_ledger_lines(body, contract), contract), seen, **_input_measures()),
                     f"ledger-{contract.dataset}")
    fields, id_field = contract.fields, contract.id_field

    invalid = checked.filter(is_invalid())
    candidates = checked.filter(is_valid())
    rep = F.min(F.struct("raw_record", "source_file", "silver_processed_at", "dq_errors"))
    unique = (
        candidates.groupBy("load_date", *fields)
        .agg(rep.alias("_rep"), F.count(F.lit(1)).alias("_copies"))
        .select("load_date", *fields, "_rep.*", "_copies")
    )
    unique = count_by(unique, ["load_date", id_field], "_id_count")
    conflicts = unique.filter(F.col("_id_count") > 1).withColumn(
        "dq_errors", F.lit("conflicting transaction ID within load date"))
    quarantine_cols = ["raw_record", "source_file", *fields, "dq_errors", "silver_processed_at", "load_date"]
    quarantine = invalid.select(*quarantine_cols).unionByName(conflicts.select(*quarantine_cols))

    valid = _observed(unique, seen, duplicate_rows_collapsed=F.sum(F.col("_copies") - 1)).filter(F.col("_id_count") == 1)
    typed = {f: F.col(f) for f in fields}
    typed["amount"] = F.col("amount").cast(MONEY)
    typed[contract.date_field] = F.to_date(F.col(contract.date_field), clean.ISO_DATE_FORMAT)
    for k in ("created_at", "updated_at"):
        typed[k] = F.to_timestamp(F.col(k))
    if contract.kind == "payments":
        typed["source_version"] = F.col("source_version").cast("int")
    valid = valid.select("source_file", *[typed[f].alias(f) for f in fields], "silver_processed_at", "load_date")

    metrics = ledger_metrics(invalid, unique, contract)
    return SilverResult(valid, quarantine, metrics, seen)


def ledger_metrics(invalid: DataFrame, unique: DataFrame, contract: LedgerContract) -> DataFrame:
    """Per load date: input = valid + quarantine + duplicates collapsed.

    One aggregation over tagged rows (no cross join, no per-metric action)."""
    inv = invalid.select("load_date", F.lit(1).alias("_invalid"), F.lit(0).alias("_copies"),
                         F.lit(0).alias("_unique"), F.lit(0).alias("_valid"), F.lit(0).alias("_conflict"))
    uni = unique.select("load_date", F.lit(0).alias("_invalid"), F.col("_copies").cast("int"),
                        F.lit(1).alias("_unique"),
                        F.when(F.col("_id_count") == 1, 1).otherwise(0).alias("_valid"),
                        F.when(F.col("_id_count") > 1, 1).otherwise(0).alias("_conflict"))
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return (
        inv.unionByName(uni).groupBy("load_date").agg(
            (s("_invalid") + s("_copies")).alias("input_rows"),
            s("_valid").alias("valid_rows"),
            (s("_invalid") + s("_conflict")).alias("quarantine_rows"),
            (s("_copies") - s("_unique")).alias("duplicate_rows_collapsed"),
        ).select(F.lit(contract.dataset).alias("dataset"), "*")
    )
