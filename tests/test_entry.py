"""Driver contract: entry() at sf0.001, every query has an oracle."""

import __spark_entry__ as E

from claimlake.plans.catalog import QUERIES

from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "policy_id" in df.columns and "reported_contribution_before_ibnr" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_build_on_small_data(spark):
    queries = E.queries()
    for name in QUERIES:
        df = queries[name](spark, SF_SMALL)
        assert df.columns, name
