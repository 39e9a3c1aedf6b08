"""Rows carry whole numbers, are dealt by their count, and wide rows move and are written few times."""

from __future__ import annotations

import os
import random
from decimal import Decimal

import pytest
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.sql import functions as F

from spendcast.operators import evaluate as ev
from spendcast.operators import features as fe
from spendcast.operators import model as mo
from spendcast.operators import partials as pt
from spendcast.operators import prepare as pr
from spendcast.session import ensure_checkpoint_dir
from spendcast.sources.transactions import fixture_transactions
from tests.conftest import make_tx

PLAN = lambda df: df._jdf.queryExecution().executedPlan().toString()


def _tx(spark, n=400):
    rng = random.Random(4)
    return make_tx(spark, [(str(i // 3), rng.choice(["85123A", "POST", "22345"]), rng.choice([1, 2, -3]), f"2010-{1 + i // 50:02d}-{1 + i % 25:02d} 10:00:00",
                            round(rng.uniform(1, 60), 2), rng.randrange(20), "EIRE") for i in range(n)])


def test_money_is_whole_and_labels_read_few_columns(spark):
    """No decimal is sorted or shuffled by customer, and the labels' rows have no sums."""
    enriched, spend = fe._enriched(_tx(spark), "chunked")
    assert not [c for c, t in enriched.dtypes if t.startswith("decimal")]
    assert fe._scales(enriched)["cumsum_total_by_prod_id"] == 2 and spend.columns == ["customer_id", "order_date", "total"]
    assert "Join" not in PLAN(spend.select("customer_id", "total")).split("Exchange hashpartitioning(customer_id")[0]
    assert dict(spend.dtypes)["total"] == "decimal(18,2)"


def test_customers_are_dealt_by_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(fe, "DEALT_ROWS", 10)
    plan = PLAN(fe.training_sets(_tx(spark), ["2010-05", "2010-07"], 50))
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_id" in line]
    assert dealt and all("REPARTITION_BY_NUM" in line and ", 30)" in line for line in dealt), dealt  # 300 of the rows are before the end


def test_statistics_of_whole_numbers_are_those_of_decimals(spark):
    rng = random.Random(8)
    rows = [(i % 5, f"2010-0{1 + i % 6}-03", i, None if i % 7 == 0 else rng.choice([rng.randrange(-999, 9 ** 6), (1 << 62) - i, -(1 << 61) + i, (1 << 53) + 1]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k int, d string, i long, whole long").withColumn("order_date", F.col("d").cast("timestamp_ntz"))
    df = df.withColumn("money", (F.col("whole").cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(28,2)"))
    cuts = ["2010-03", "2010-07"]

    def states(c, scales):
        made = pt.month_partials(df.withColumn("v", F.col(c)), ["k"], ["v"], cuts=cuts, scales=scales)
        return {(r.k, r[pt.MONTH]): (r.n_v, Decimal(r.s_v or 0), r.lo_v, r.hi_v, r.m2_v, r.m3_v) for r in made.collect()}

    got, want = states("whole", {"v": 2}), states("money", None)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key][:4] == want[key][:4] and got[key][4:] == pytest.approx(want[key][4:], rel=1e-9), key


@pytest.fixture
def tables(spark, tmp_path):
    """Two rows of customer 2, none of 3, none for a null; order 12 twice, with and without a known customer."""
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    write("customer", [(1, 3), (2, 1), (2, 2), (None, 1), (5, 24)], "c_custkey long, c_nationkey int")
    write("nation", [(i, f"N{i}") for i in range(25)], "n_nationkey int, n_name string")
    write("part", [(1, "a", 1, 2.5), (2, "b", 3, 10.0)], "p_partkey long, p_name string, p_size int, p_retailprice double")
    write("orders", [(10, 1, "2001-01-05"), (11, 2, "2001-01-06"), (12, 1, "2001-01-07"), (12, 3, "2001-01-08"), (13, None, "2001-01-08"), (14, 5, "2001-01-09")],
          "o_orderkey long, o_custkey long, o_orderdate string")
    lines = [(o, p, 1, n, float(q), 1.0, 0.0, 0.0, "N", "O", "2001-02-01") for o in (10, 11, 12, 13, 14) for n, (p, q) in enumerate([(1, 4), (2, 5)], 1)]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                             "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string")
    return str(tmp_path)


def test_customers_meet_the_orders(spark, tables):
    """As lines joined to customers: repeated keys repeat lines with their numbers, unknown ones drop them."""
    got = fixture_transactions(spark, tables)
    seen = sorted((r.order_id, r.line_seq, r.quantity, r.customer_id, r.country) for r in got.collect())
    want = [("500010", 1, 4, 1, "EIRE"), ("500010", 2, 5, 1, "EIRE"), ("500014", 1, 4, 5, "N24"), ("500014", 2, 5, 5, "N24")]
    want += [("500011", n, q, 2, c) for n, q in ((1, 4), (2, 5)) for c in ("France", "Germany")]
    twelve = [r for r in seen if r[0] == "500012"]
    assert sorted(want) == [r for r in seen if r[0] != "500012"]
    assert sorted((q, c, k) for _, _, q, c, k in twelve) == [(4, 1, "EIRE"), (5, 1, "EIRE")]
    assert {n for _, n, _, _, _ in twelve} <= {1, 2, 3, 4}  # numbered among the lines of both orders
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture_transactions(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert len(moved) == 1 and "l_partkey" not in plan.split(moved[0])[1].split("Scan")[0], plan


def _tables_written(spark, action):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    out = action()
    sizes = [sum(os.path.getsize(os.path.join(folder, d, f)) for f in os.listdir(os.path.join(folder, d))) for d in set(os.listdir(folder)) - before]
    return out, sizes


def test_medians_of_a_stored_table_write_no_wide_rows(spark, tmp_path):
    spark.range(4000).select(*[(F.col("id") * (2 * i + 1) % 997 / 7).alias(f"x{i}") for i in range(30)]).write.parquet(str(tmp_path / "w"))
    df, cols = spark.read.parquet(str(tmp_path / "w")), [f"x{i}" for i in range(30)]
    want, wide = _tables_written(spark, lambda: pr.fit_medians(df, cols))
    (_, _, got), few = _tables_written(spark, lambda: pr.impute_median(df, df, cols, stored=True))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert max(few) * 2 < max(wide)


def _wide(spark, n=600):
    rng = random.Random(5)
    rows = [(rng.choice([None, rng.randrange(400)]) if i % 9 == 0 else i, None if i % 50 == 0 else int(i % 3 == 0), rng.random(), rng.random()) for i in range(n)]
    return spark.createDataFrame(rows, "customer_id long, label int, a double, b double")


def test_folds_of_wide_rows_are_those_of_narrow_ones(spark):
    """Repeated and null ids and null labels too: rows of an id take the same ranks, in any order."""
    df = _wide(spark)
    got, sizes = _tables_written(spark, lambda: ev.stratified_folds(df, k=4))
    assert got.columns == [*df.columns, "fold"]
    count = lambda d: sorted((str(r.customer_id), str(r.label), str(r.fold)) for r in d.collect())
    assert count(got) == count(ev.stratified_folds(df.select("customer_id", "label"), k=4))
    assert sorted(map(str, got.drop("fold").collect())) == sorted(map(str, df.collect()))
    ids = _tables_written(spark, lambda: ev.stratified_folds(df.withColumns({f"c{i}": F.rand(i) for i in range(50)}), k=4))[1]
    assert max(ids) < 1.5 * max(sizes)  # what the scan writes does not grow with the columns
    wide = [line for line in PLAN(got).splitlines() if "Exchange" in line and "hashpartitioning(_key" in line]
    assert len(wide) == 2  # the rows once, the ranks once


def test_test_rows_are_read_once_by_all_models(spark, monkeypatch):
    df = _wide(spark).where("customer_id is not null and label is not null").dropDuplicates(["customer_id"])
    seen = []
    monkeypatch.setattr(mo, "fold_mean", lambda preds, key: (seen.append(preds), ev.fold_mean(preds, key))[1])
    est = LogisticRegression(maxIter=3)
    oof, mean, _ = mo.oof_predict(df, df.where("customer_id < 100"), ["a", "b"], est, k=3)
    assert PLAN(seen[0]).count("Scan") == 1 and oof.count() == df.count()
    folded = ev.stratified_folds(df, "label", 3, 42)
    models = [mo._pipeline(["a", "b"], est).fit(folded.where(F.col("fold") != i)) for i in range(3)]
    want = {}
    for m in models:
        for r in mo._score(m, df.where("customer_id < 100"), ["customer_id"]).collect():
            want.setdefault(r.customer_id, []).append(r.probability)
    got = {r.customer_id: r.probability for r in mean.collect()}
    assert got == pytest.approx({k: sum(v) / 3 for k, v in want.items()}, rel=1e-6)


def test_fits_at_once_shrink_with_the_rows(spark, monkeypatch):
    df = _wide(spark).where("customer_id is not null and label is not null")
    workers = []
    pool = mo.ThreadPoolExecutor
    monkeypatch.setattr(mo, "ThreadPoolExecutor", lambda max_workers: (workers.append(max_workers), pool(max_workers))[1])
    for most in (1, 3 * 2 * df.count(), 10 ** 9):
        monkeypatch.setattr(mo, "FIT_VALUES", most)
        mo.oof_predict(df, df, ["a", "b"], LogisticRegression(maxIter=1), k=4)
    assert workers == [1, 3, 4]


def test_rows_are_assembled_once_for_all_folds(spark, monkeypatch):
    """The folds' table holds the vector and no feature columns; weights and the like stay."""
    df = _wide(spark).where("customer_id is not null and label is not null").withColumn("w", F.lit(2.0))
    stored = []
    write = mo.materialize
    monkeypatch.setattr(mo, "materialize", lambda d: (stored.append(d.columns), write(d))[1])
    oof, _, fi = mo.oof_predict(df, df, ["a", "b"], NaiveBayes(modelType="gaussian", weightCol="w"), k=3)
    assert stored == [["customer_id", "label", "w", "fold", "features"]]
    assert oof.columns == ["customer_id", "fold", "label", "probability"] and oof.count() == df.count()
    assert {(r.feature, r.fold) for r in fi.collect()} == {(f, i) for f in "ab" for i in range(3)}
