"""Fail-fast assertions expressed as composable "violations" DataFrames.

Each check is a DataFrame of offending rows.  All checks of a job are
unioned into one (check, key, detail) frame and evaluated with a single
bounded action (``limit``), so shared inputs are scanned once per job
instead of once per assertion, and no unbounded result reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 5


@dataclass
class Check:
    message: str
    rows: DataFrame
    keys: list[str] = field(default_factory=list)
    detail: str | None = None

    def as_rows(self) -> DataFrame:
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in self.keys]) \
            if self.keys else F.lit("")
        detail = F.col(self.detail).cast("string") if self.detail else F.lit(None).cast("string")
        return self.rows.select(F.lit(self.message).alias("check"), key.alias("key"), detail.alias("detail"))


def violation_rows(checks: list[Check]) -> DataFrame:
    return reduce(DataFrame.unionByName, [c.as_rows() for c in checks])


class CheckFailed(ValueError):
    """Raised when a job's input would make a published figure ambiguous."""


def require_empty(violations: DataFrame, message: str | None = None) -> None:
    """One action: fetch at most a few offending rows and raise if any."""
    sample = violations.limit(SAMPLE_ROWS).collect()
    if sample:
        names = sorted({r["check"] for r in sample}) if "check" in violations.columns else []
        head = message or "; ".join(names) or "check failed"
        raise CheckFailed(head + ": " + str([r.asDict() for r in sample]))
