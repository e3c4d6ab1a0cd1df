"""Every registered query against its DuckDB oracle on the smallest data set
(names, row count, order-insensitive value hash) -- the driver's gate, in pytest."""

import duckdb
import pytest

import __spark_entry__ as E
from claimlake.plans.catalog import QUERIES as CATALOG
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest

QUERIES = {name: E.queries()[name] for name in CATALOG}
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    oracle_cols = [d[0] for d in cur.description]
    oracle_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(oracle_cols)
    assert len(spark_rows) == len(oracle_rows)
    assert digest(df.columns, spark_rows)[0] == digest(oracle_cols, oracle_rows)[0]
