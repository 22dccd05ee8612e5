"""Every registered query against its DuckDB twin on the smallest fixtures."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duckdb_conn
from tutorlens.plans import oracle, queries

QUERIES = queries.QUERIES
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf001):
    return duckdb_conn(sf001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf001, name):
    got = QUERIES[name](spark, sf001).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = con.execute(SQL[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "target" in df.columns
