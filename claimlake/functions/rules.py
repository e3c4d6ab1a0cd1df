"""Data-quality rules as data: an ordered list of (message, predicate).

``error_list`` folds the list into one string column with every failing
message in rule order, separated by "; ".  A NULL predicate counts as
"not failing", exactly like ``when`` without ``otherwise``; an empty string
means the row passed every rule.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]
SEPARATOR = "; "


def error_list(rules: Iterable[Rule]) -> Column:
    return F.concat_ws(SEPARATOR, *[F.when(pred, F.lit(msg)) for msg, pred in rules])


def is_valid(name: str = "dq_errors") -> Column:
    return F.length(F.col(name)) == 0


def is_invalid(name: str = "dq_errors") -> Column:
    return F.length(F.col(name)) > 0


def missing(c: str) -> Column:
    """NULL or empty (after the feed's own trimming)."""
    return F.col(c).isNull() | (F.length(F.col(c)) == 0)


def not_in(c: str, values: list[str]) -> Column:
    """True when the value is NULL or outside the allowed list."""
    return F.col(c).isNull() | ~F.col(c).isin(*values)
