"""Policy changes, Bronze to Silver (D1): type, validate, quarantine, collapse re-sent rows.

The event key is ``policy_change_id``; order is given by ``source_version`` and
``source_updated_at``.  Identical rows of a load date collapse; rows that share an id
and differ are all quarantined.  A change must name a policy that exists, raise the
policy's version (against the feed's previous change, else against the history so far)
and must not take effect before the business date of its update.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean
from ..functions.plan import evaluated_once
from ..functions.rules import Rule, error_list, is_invalid, is_valid, missing
from ..schemas import MONEY, POLICY_CHANGE_FIELDS, POLICY_CHANGE_OPERATIONS
from .silver import SilverResult, count_by

COLUMNS = POLICY_CHANGE_FIELDS + ["source_file", "silver_processed_at"]


def typed_policy_changes(raw: DataFrame) -> DataFrame:
    """Typed changes, one row per distinct business row of a load date."""
    t = clean.trimmed
    typed = raw.select(
        *[t(c).alias(c) for c in ("policy_change_id", "policy_id")],
        F.upper(t("operation")).alias("operation"),
        t("source_version").try_cast("int").alias("source_version"),
        clean.strict_date(t("effective_date")).alias("effective_date"),
        F.upper(t("change_type")).alias("change_type"),
        *[F.nullif(t(c), F.lit("")).alias(c) for c in ("old_coverage_type", "new_coverage_type")],
        *[t(c).try_cast(MONEY).alias(c) for c in ("old_annual_premium", "new_annual_premium")],
        t("source_system").alias("source_system"),
        clean.zoned_timestamp(t("source_updated_at")).alias("source_updated_at"),
        "source_file", "load_date")
    return typed.groupBy("load_date", *POLICY_CHANGE_FIELDS).agg(F.min("source_file").alias("source_file")) \
        .withColumn("silver_processed_at", F.current_timestamp())


def policy_change_rules() -> list[Rule]:
    c = F.col
    negative = [(f"{k} is negative", c(k) < 0) for k in ("old_annual_premium", "new_annual_premium")]
    return [
        ("policy_change_id is missing", missing("policy_change_id")),
        ("policy_id is missing", missing("policy_id")),
        ("operation is invalid", c("operation").isNull() | ~c("operation").isin(*POLICY_CHANGE_OPERATIONS)),
        ("source_version is invalid", c("source_version").isNull() | (c("source_version") <= 0)),
        ("effective_date is invalid", c("effective_date").isNull()),
        ("change_type is missing", missing("change_type")),
        ("new_coverage_type is missing", missing("new_coverage_type")),
        ("new_annual_premium is invalid", c("new_annual_premium").isNull()),
        *negative,
        ("source_updated_at is invalid", c("source_updated_at").isNull()),
        ("policy does not exist", c("_known").isNull() & ~missing("policy_id")),
        ("source_version does not increase", c("source_version") <= c("_previous_version")),
        ("effective_date is before the update's business date", c("effective_date") < F.to_date("source_updated_at")),
        ("conflicting policy_change_id within load date", ~missing("policy_change_id") & (c("_id_count") > 1)),
    ]


def checked_policy_changes(raw: DataFrame, policies: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Typed changes + dq_errors.  ``history``: the versions published before these load dates."""
    typed = evaluated_once(typed_policy_changes(raw))
    known = policies.select("policy_id").distinct().withColumn("_known", F.lit(True))
    by_update = Window.partitionBy("policy_id").orderBy(
        "load_date", "source_updated_at", "policy_change_id", "source_version", *[c for c in POLICY_CHANGE_FIELDS if c not in (
            "policy_id", "source_updated_at", "policy_change_id", "source_version")])  # a total order: reruns agree
    rows = count_by(typed, ["load_date", "policy_change_id"], "_id_count").join(known, "policy_id", "left")
    previous = F.lag("source_version").over(by_update)
    if history is not None:
        newest = history.groupBy("policy_id").agg(F.max("source_version").alias("_newest"))
        rows, previous = rows.join(newest, "policy_id", "left"), F.coalesce(previous, F.col("_newest"))
    rows = rows.withColumn("_previous_version", previous)
    return evaluated_once(rows.withColumn("dq_errors", error_list(policy_change_rules())).select(*COLUMNS, "dq_errors", "load_date"))


def silver_policy_changes(raw: DataFrame, policies: DataFrame, history: DataFrame | None = None) -> SilverResult:
    checked = checked_policy_changes(raw, policies, history)
    return SilverResult(checked.where(is_valid()).select(*COLUMNS, "load_date"),
                        checked.where(is_invalid()).select(*COLUMNS, "dq_errors", "load_date"))
