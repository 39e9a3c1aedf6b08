"""Invariants on the fixture data: no leakage through the cut, order
independence, chunked == window for the whole feature matrix, model output
shape."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from spendcast.functions.periods import history_before, month_start
from spendcast.operators import evaluate as ev
from spendcast.operators import features as fe
from spendcast.operators import model as mo
from spendcast.operators import prepare as pr
from spendcast.sources.transactions import fixture_transactions

M = "2001-07"


def _rows(df):
    return sorted(tuple(r) for r in df.orderBy("customer_id").collect())


def test_future_rows_do_not_leak(spark):
    tx = fixture_transactions(spark, SMOKE)
    base = fe.feature_matrix(tx, M, max_rows=45)
    # rows at or after the cut: doubled quantities and totals must not matter
    future = tx.where(F.col("order_date") >= month_start(M)).withColumn(
        "total", (F.col("total") * 2).cast("decimal(18,2)"))
    changed = history_before(tx, M).unionByName(future)
    assert _rows(base) == _rows(fe.feature_matrix(changed, M, max_rows=45))


def test_order_independence_and_chunked(spark):
    tx = fixture_transactions(spark, SMOKE)
    base = fe.feature_matrix(tx, M, max_rows=45, method="window")
    shuffled = tx.repartition(5, F.rand(3))
    chunked = fe.feature_matrix(shuffled, M, max_rows=45, method="chunked")
    a, b = _rows(base), _rows(chunked)
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert (u is None and v is None) or abs(u - v) <= 1e-9 * max(1.0, abs(u))


def test_oof_predictions_shape(spark):
    tx = fixture_transactions(spark, SMOKE)
    train, test, names = fe.build_datasets(tx, M, thr=25000, max_rows=45)
    train, test, _ = pr.impute_median(train, test, names)
    est = mo.default_estimator(max_iter=3, max_depth=3)
    oof, test_mean, fi = mo.oof_predict(train, test, names, est, k=2)
    n_train, n_test = train.count(), test.count()
    assert oof.count() == n_train and oof.select("customer_id").distinct().count() == n_train
    assert test_mean.count() == n_test
    lo, hi = test_mean.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= lo <= hi <= 1.0
    assert fi.count() == 2 * len(names)


def test_oof_early_stopping(spark):
    tx = fixture_transactions(spark, SMOKE)
    train, test, names = fe.build_datasets(tx, M, thr=25000, max_rows=45)
    train, test, _ = pr.impute_median(train, test, names)
    oof, test_mean, _ = mo.oof_predict(train, test, names, k=2, early_stopping=True,
                                       estimator=mo.default_estimator(
                                           max_iter=4, max_depth=2, validation_col="_is_val"))
    assert oof.count() == train.count()
    assert test_mean.where("probability < 0 OR probability > 1").count() == 0


def _random_labels(spark):
    return spark.range(400).select(
        F.col("id").alias("customer_id"), F.rand(5).alias("a"), F.rand(6).alias("b"),
        (F.rand(7) > 0.5).cast("int").alias("label"))


def test_early_stopping_does_not_learn_the_held_out_fold(spark):
    rows = _random_labels(spark)
    est = mo.default_estimator(max_iter=10, max_depth=4)  # without a validation column of its own
    oof, _, _ = mo.oof_predict(rows, rows, ["a", "b"], est, k=3, early_stopping=True)
    assert 0.35 < ev.auc(oof).first().auc < 0.65


def test_other_estimators_fit_the_slot(spark):
    rows = _random_labels(spark)
    for est in (RandomForestClassifier(numTrees=3, seed=1), LogisticRegression(maxIter=5)):
        preds, fi = mo.fit_predict(rows, rows, ["a", "b"], est)
        assert preds.count() == 400 and {r.feature for r in fi.collect()} == {"a", "b"}
