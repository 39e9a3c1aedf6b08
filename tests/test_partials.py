"""Month partials and their merge against direct aggregates; scan state, codes,
encoding, sorted writes."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from spendcast.operators import features as fe
from spendcast.operators import partials as pt
from spendcast.operators import prepare as pr
from spendcast.operators.lookups import first_seen_code
from spendcast.operators.scan import prefix_scan
from spendcast.operators.stats import customer_stats
from spendcast.session import ensure_checkpoint_dir
from spendcast.sources import sinks
from spendcast.sources.transactions import fixture_transactions
from tests.conftest import SMOKE, make_tx

COLUMNS = ("quantity", "price", "total")
SPEC = [(c, fe.SEVEN_STATS) for c in COLUMNS]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    out = []
    for i in range(900):
        cust = rng.choice([1, 2, 3, 4, 5, None])
        price = {1: 0.07, 2: 9_000_000.01}.get(cust) if rng.random() < 0.9 or cust in (1, 2) else None
        price = price if price is not None or cust is None else round(rng.uniform(0, 50), 2) if rng.random() < 0.8 else None
        out.append((str(i // 4), f"{10000 + i % 50}", rng.choice([1, 2, -3, None]), f"2010-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d} 10:00:00",
                    price, cust, rng.choice(["EIRE", "France", None])))
    return make_tx(spark, out + [("x", "1", 5, "2010-03-01 00:00:00", None, 9, "Spain"), ("x", "1", None, "2010-05-01 00:00:00", None, 9, "Spain")])


def _near(a, b):
    return a is None and b is None or a is not None and b is not None and abs(float(a) - float(b)) <= 1e-9 * max(1.0, abs(float(b)))


@pytest.mark.parametrize("by_cut", [True, False])
def test_merged_states_equal_direct_statistics(spark, rows, by_cut):
    cuts = ["2010-01", "2010-03", "2010-04", "2010-09", "2011-02"]
    partials = pt.month_partials(rows, ["customer_id"], COLUMNS, cuts=cuts if by_cut else (), distinct={"order_id": "order_id"})
    states = pt.at_cuts(pt.running(partials, ["customer_id"], COLUMNS, distinct=["order_id"]), cuts)
    got = {(r.as_of, r.customer_id): r.asDict() for r in states.select(
        "customer_id", "as_of", *[pt.statistic(c, s).alias(f"{c}-{s}") for c, stats in SPEC for s in stats], F.col("new_order_id").alias("order_id-nunique")).collect()}
    seen = 0
    for cut in cuts:
        want = customer_stats(pt_before(rows, cut), [*SPEC, ("order_id", ("nunique",))]).collect()
        seen += len(want)
        for r in want:
            for name, v in r.asDict().items():
                assert _near(got[cut, r.customer_id][name], v), (cut, r.customer_id, name, got[cut, r.customer_id][name], v)
    assert seen == len(got)
    one = pt.stats_at_cuts(rows, SPEC, ["2010-09"]).collect()
    assert all(_near(r[f"{c}-{s}"], got["2010-09", r.customer_id][f"{c}-{s}"]) for r in one for c, stats in SPEC for s in stats)


def pt_before(rows, cut):
    from spendcast.functions.periods import history_before
    return history_before(rows, cut)


def test_feature_matrix_uses_hash_aggregates_and_one_scan_of_rows(spark):
    enriched = fe.enrich_rows(fixture_transactions(spark, SMOKE))
    many = fe.feature_matrices(None, [f"2001-{m:02d}" for m in range(1, 9)], enriched)
    plan = many._jdf.queryExecution().optimizedPlan().toString() + many._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert plan.count("Generate explode") <= 2  # the cuts, of merged states


def test_code_key_sorts_like_the_code(spark):
    codes = ["", "1", "12345", "12345A", "123456789", "POST", "C2", "é1234", "１２３４５", "12345é", "1234é6", " 1234"]
    df = spark.createDataFrame([(c,) for c in codes] + [(None,)], "product_id string")
    got = df.select("product_id", fe._code_key().alias("k")).withColumn("start", fe._code_start("k"))
    from spendcast.functions.codes import product_anomalous
    for r in got.select("*", product_anomalous("product_id").alias("a"), product_anomalous("start").alias("b")).collect():
        assert r.a == r.b, r
    keyed = [r for r in got.collect() if r.product_id is not None]
    assert [r.product_id.encode()[:7] for r in sorted(keyed, key=lambda r: r.k)] == sorted(c.encode()[:7] for c in codes)


def test_first_seen_code_of_a_column_with_a_value_per_row(spark):
    df = spark.range(5000).select(F.concat(F.lit("v"), ((F.col("id") * 7919) % 5000).cast("string")).alias("v"),
                                  F.floor(F.col("id") / 10).alias("a"), F.col("id").alias("b"))
    got = {r.v: r.v_code for r in first_seen_code(df, "v", [F.col("a"), F.col("b")]).collect()}
    assert got == {f"v{i * 7919 % 5000}": i for i in range(5000)}


def test_label_encode_columns_together(spark):
    train = spark.createDataFrame([(1, "b", "x"), (2, None, "y"), (3, "a", None)], "id int, p string, `q r` string")
    test = spark.createDataFrame([(4, "c", "x"), (5, "a", "z")], "id int, p string, `q r` string")
    tr, te = pr.label_encode(train, test, ["p", "q r"])
    assert tr.columns == train.columns
    assert sorted(map(tuple, tr.collect())) == [(1, 1, 0), (2, 3, 1), (3, 0, 3)] and sorted(map(tuple, te.collect())) == [(4, 2, 0), (5, 0, 2)]
    tr, _ = pr.label_encode(train, test, ["p"], suffix="_code")
    assert tr.columns == ["id", "p", "q r", "p_code"]


def test_scan_pins_what_is_asked_for(spark):
    def pinned(**kw):
        folder = ensure_checkpoint_dir(spark).removeprefix("file:")
        before = set(os.listdir(folder))
        out = prefix_scan(df, ["k"], [F.col("id")], sums={"s": "v"}, **kw)
        new = [os.path.join(folder, d) for d in set(os.listdir(folder)) - before]
        return out, sum(os.path.getsize(os.path.join(d, f)) for d in new for f in os.listdir(d))

    df = spark.range(4000).select("id", (F.col("id") % 3).alias("k"), (F.col("id") % 10).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("wide"))
    wide, all_bytes = pinned()
    narrow, few_bytes = pinned(keep=["id"])
    assert narrow.columns == ["id", "s"] and few_bytes * 3 < all_bytes
    assert {(r.id, r.s) for r in narrow.collect()} == {(r.id, r.s) for r in wide.select("id", "s").collect()}


def test_sorted_write_and_its_check(spark, tmp_path):
    df = spark.range(3000).select((F.col("id") * 7 % 101).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") * 13 % 997).alias("b"))
    report = lambda p: tuple(sinks.sort_inversions(spark, p, ["a", "b"]).first())
    good = report(sinks.write_sorted(df, str(tmp_path / "good"), ["a", "b"], files=4))
    assert good[0] == 3000 and good[1] > 1 and good[2] == 0
    df.coalesce(2).write.parquet(str(tmp_path / "bad"))
    assert report(str(tmp_path / "bad"))[2] > 100
    df.sortWithinPartitions("a", "b").write.parquet(str(tmp_path / "halves"))
    assert report(str(tmp_path / "halves"))[2] >= 1
