"""Every registered query with oracle SQL matches DuckDB on the smoke data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import SMOKE
from tests.harness import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()

@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    df = entry.entry(spark)
    assert df.columns[0] == "customer_id" and len(df.columns) == 125
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SMOKE)
    assert r["cols_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["approx"], r
