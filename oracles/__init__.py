"""DuckDB oracle SQL for every registered query (test-side only)."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from . import gold_sql, history_sql, ibnr_sql, silver_sql
    out: dict[str, str] = {}
    out.update(gold_sql.ORACLES)
    out.update(silver_sql.ORACLES)
    out.update(ibnr_sql.ORACLES)
    out.update(history_sql.ORACLES)
    return out
