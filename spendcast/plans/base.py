"""Query registry primitives: name -> (Spark plan builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)``, reads the fixture tables in
``sf_dir`` and returns a lazy DataFrame over the whole tables.  The oracle
SQL computes the same columns (same names) with DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spendcast.plans.fixture_sql import with_tx  # noqa: F401  (re-exported to the query modules)
from spendcast.sources.transactions import fixture_transactions

# Fixture parameters (the library defaults stay those of the original task:
# threshold 300, outlier max_rows 20, suspects n 3, quantile 0.999).
MONTH = "2001-07"
PREV_MONTH = "2001-06"
THR = 25000
MAX_ROWS = 45
SUSPECT_N = 15
TOP_Q = 0.99
BAND_THR = 50000

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def tx(spark: SparkSession, sf_dir: str, date_col: str = "o_orderdate") -> DataFrame:
    return fixture_transactions(spark, sf_dir, date_col)


