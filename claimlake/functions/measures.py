"""Economic column expressions shared by Gold and the IBNR model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import GOLD_EXPOSURE, GOLD_MONEY


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Gold money: decimal(28,4)."""
    return col(c).cast(GOLD_MONEY)


def money_or_zero(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0)).cast(GOLD_MONEY)


def exposure_or_zero(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0)).cast(GOLD_EXPOSURE)


def guarded_ratio(numerator: str | Column, denominator: str | Column, as_double: bool = False) -> Column:
    """numerator / denominator only where the denominator is positive, else NULL.

    A negative denominator must also give NULL, so this is not try_divide.
    """
    n, d = col(numerator), col(denominator)
    if as_double:
        n, d = n.cast("double"), d.cast("double")
    return F.when(col(denominator) > 0, n / d)


def count_if(predicate: Column) -> Column:
    """SUM(CASE WHEN p THEN 1 ELSE 0 END) as a bigint."""
    return F.sum(F.when(predicate, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def date_lit(value: str) -> Column:
    return F.lit(value).cast("date")


def development_age(month: Column, last_closed: int) -> Column:
    """Month-ends closed since the month of ``month`` ended; 0 for a month that has not.

    ``last_closed``: number of the last month that has ended (``calendar.month_number``)."""
    return F.greatest(F.lit(last_closed) - (F.year(month) * 12 + F.month(month) - 1), F.lit(0)).cast("int")
