"""Calendar arguments of the jobs, read in one place."""

from __future__ import annotations

from datetime import date, timedelta


def iso_day(text: str) -> date:
    """A calendar day written as YYYY-MM-DD, and in no other way."""
    day = date.fromisoformat(text) if isinstance(text, str) else None
    if day is None or str(day) != text:
        raise ValueError(f"not a calendar day written YYYY-MM-DD: {text!r}")
    return day


def window(start: str, end: str, whole_months: bool = False) -> tuple[date, date]:
    """The days that bound a history; ``whole_months``: it begins on a month's first day."""
    days = iso_day(start), iso_day(end)
    if days[1] < days[0]:
        raise ValueError(f"the history begins {start}, after it ends {end}")
    if whole_months and days[0].day > 1:
        raise ValueError(f"the history must begin on the first day of a month, not on {start}")
    return days


def ends_month(day: date) -> bool:
    return (day + timedelta(days=1)).month != day.month


def month_number(day: date) -> int:
    """Months since year 0."""
    return 12 * day.year + day.month - 1
