"""The scan in order of time equals plain windows; the rows move few times."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from spendcast.operators import features as fe
from spendcast.operators import timeline as tl
from spendcast.operators.scan import prefix_scan
from spendcast.sources.transactions import ORDER_KEY, order_cols
from tests.conftest import make_tx


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    out = []
    for i in range(1500):
        order = rng.choice([None, str(i // 5), str(i // 5), str(i // 5), "many days"])
        code = rng.choice([None, "85123A", "POST", "22345", "22399", "85200"])
        price = None if rng.random() < 0.1 else round(rng.uniform(-3, 60), 2)
        out.append((order, code, rng.choice([1, 2, -3, None]), f"2010-{1 + i // 130:02d}-{1 + i // 5 % 26:02d} 10:00:00", price,
                    rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice(["EIRE", "France", "Spain", None])))
    return make_tx(spark, out).withColumn("product_prefix", F.substring("product_id", 1, 3)).repartition(5)


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "37")
    yield
    spark.conf.set(key, old)


def _sums(df, spread, run):
    return {(r.line_seq, *[r[c] for c in (*spread, *run)]) for r in df.collect()}


@pytest.mark.parametrize("sent", [0, tl.SENT_ROWS])
def test_sums_equal_windows(spark, rows, small_batches, monkeypatch, sent):
    monkeypatch.setattr(tl, "SENT_ROWS", sent)
    got = tl.in_time_order(rows, ORDER_KEY, ("product_prefix", fe.PROD_SUMS), ("order_id", fe.ORDER_SUMS), ["order_date", "order_id"], num_chunks=6)
    want = prefix_scan(rows, ["product_prefix"], order_cols(), sums=fe.PROD_SUMS, method="window")
    want = prefix_scan(want, ["order_id"], order_cols(), sums=fe.ORDER_SUMS, method="window")
    assert _sums(got, fe.PROD_SUMS, fe.ORDER_SUMS) == _sums(want, fe.PROD_SUMS, fe.ORDER_SUMS)
    assert {c: t for c, t in got.dtypes if c.startswith("cumsum")} == {c: t for c, t in want.dtypes if c.startswith("cumsum")}
    by_time = [r.line_seq for r in got.where("order_id is not null").orderBy(tl.POS).collect()]
    assert by_time == [r.line_seq for r in rows.where("order_id is not null").orderBy(*ORDER_KEY).collect()]
    runs = got.where("order_id is not null").select("order_id", tl.RUN).distinct().collect()
    assert len(runs) == len({r.order_id for r in runs}) == len({r[tl.RUN] for r in runs})


def _features(df):
    return sorted(tuple(None if v is None else round(v, 6) for v in r) for r in df.drop("as_of").collect())


@pytest.mark.parametrize("hot", [fe.HOT_ROWS, 300])
def test_features_equal_plain_windows_with_a_hot_customer(spark, rows, small_batches, monkeypatch, hot):
    monkeypatch.setattr(fe, "HOT_ROWS", hot)
    df, cuts = rows.drop("product_prefix"), ["2010-04", "2010-11"]
    want = _features(fe.feature_matrices(df, cuts, method="window"))
    assert _features(fe.feature_matrices(df, cuts)) == want and len(want) == 8


def test_sums_beyond_18_digits_take_the_plain_scan(spark):
    rows = make_tx(spark, [(str(i), "85123", 999_999, f"2010-01-{i + 1:02d} 10:00:00", 9_999_999_999.99, 1, "EIRE") for i in range(20)])
    want = _features(fe.feature_matrices(rows, ["2010-03"], method="window"))
    got = _features(fe.feature_matrices(rows, ["2010-03"]))
    assert got == want and want[0][1 + fe.FEATURE_NAMES.index("cumsum_total_by_prod_id-max")] > 1.9e17


def test_wide_rows_are_dealt_once_by_customer(spark, rows):
    """Scans, statistics, cuts and labels of all months meet in the exchange of the rows by customer."""
    sets = fe.training_sets(rows.drop("product_prefix"), ["2010-06", "2010-09", "2010-12"], 50)
    assert sets.count() == 12
    plan = sets._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(wide) == 2 and all("hashpartitioning(customer_id" in line for line in wide), plan  # rows and labels
