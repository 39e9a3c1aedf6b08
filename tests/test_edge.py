"""Hand-made edge rows: codes, cuts, labels, null and small-group statistics,
lookups, imputation, encoding, AUC."""

from __future__ import annotations

import itertools

import pandas as pd
import pytest

from spendcast.sources.transactions import TRANSACTIONS_SCHEMA, read_transactions
from pyspark.sql import functions as F

from tests.conftest import make_tx
from spendcast.functions.codes import normalize_product_id, order_id_anomalous, product_anomalous
from spendcast.functions.periods import add_months, history_before, in_month, prev_month
from spendcast.operators import anomalies as an
from spendcast.operators import evaluate as ev
from spendcast.operators import explore as ex
from spendcast.operators import lookups as lk
from spendcast.operators import prepare as pr
from spendcast.operators import stats as st
from spendcast.operators.labels import baseline_prob, customer_spine, month_label


def test_month_arithmetic():
    assert prev_month("2011-12") == "2011-11"
    assert prev_month("2011-01") == "2010-12"
    assert add_months("2010-11", 2) == "2011-01"


def test_codes(spark):
    codes = ["85123A", "15056BL", "POST", "C2", "BANK CHARGES", "TEST001", "1234", "", None, "12345"]
    df = spark.createDataFrame([(c,) for c in codes], "p string")
    got = {r.p: (r.n, r.a) for r in df.select(
        "p", normalize_product_id("p").alias("n"), product_anomalous("p").alias("a")).collect()}
    assert got["85123A"] == ("85123", False)
    assert got["15056BL"] == ("15056B", False)
    assert got["POST"] == ("POST", True)
    assert got["C2"] == ("C", True)
    assert got["BANK CHARGES"] == ("BANK CHARGE", True)
    assert got["TEST001"] == ("TEST00", True)
    assert got["1234"] == ("1234", False)
    assert got[""] == ("", True)
    assert got[None] == (None, None)
    ids = spark.createDataFrame([(x,) for x in ["536365", "C536379", "A563185", ""]], "o string")
    flags = {r.o: r.f for r in ids.select("o", order_id_anomalous("o").alias("f")).collect()}
    assert flags == {"536365": False, "C536379": False, "A563185": True, "": True}


@pytest.fixture(scope="module")
def rows(spark):
    return make_tx(spark, [
        # customer 1: history, then spend exactly at the threshold in 2011-12
        ("1001", "85123A", 10, "2011-10-03 10:00:00", 1.0, 1, "United Kingdom"),
        ("1002", "85123A", 300, "2011-12-01 00:00:00", 1.0, 1, "United Kingdom"),
        # customer 2: history, spends above the threshold in the target month
        ("1003", "22423", 1, "2011-09-10 09:00:00", 12.75, 2, "France"),
        ("1004", "22423", 40, "2011-12-05 09:00:00", 12.75, 2, "France"),
        # customer 3: refund only in the previous month
        ("1005", "22423", 2, "2011-08-01 00:00:00", 5.0, 3, "Germany"),
        ("C1006", "22423", -2, "2011-11-02 00:00:00", 5.0, 3, "Germany"),
        # customer 4: first seen in the previous month (spends 600)
        ("1007", "POST", 1, "2011-11-20 00:00:00", 600.0, 4, "Atlantis"),
        # customer 5: first seen in the target month
        ("1008", "22423", 1, "2011-12-02 00:00:00", 400.0, 5, "Spain"),
        # customer 6: previous-month spend above the threshold
        ("1009", "22423", 1, "2010-12-01 00:00:00", 1.0, 6, "Spain"),
        ("1010", "22423", 1, "2011-11-30 23:59:59", 450.0, 6, "Spain"),
    ])


def test_month_label(rows):
    lab = {r.customer_id: r for r in month_label(rows, "2011-12", 300).collect()}
    assert set(lab) == {1, 2, 3, 4, 6}  # 5 is first seen in the month
    assert lab[1].total == 300.0 and lab[1].label == 0  # strict >
    assert lab[2].label == 1
    assert lab[3].total == 0.0 and lab[3].label == 0


def test_spine_cut_at_midnight(rows):
    # the row at exactly 2011-12-01 00:00 belongs to the month, not the history
    spine = {r.customer_id for r in customer_spine(rows, "2011-12").collect()}
    assert spine == {1, 2, 3, 4, 6}
    assert history_before(rows, "2011-12").where("order_id = '1002'").count() == 0
    assert in_month(rows, "2011-12").where("order_id = '1002'").count() == 1


def test_baseline(rows):
    p = {r.customer_id: r.probability for r in baseline_prob(rows, "2011-12", 300).collect()}
    assert p[6] == 1.0  # clipped
    assert p[3] == 0.0  # refund: negative ratio clipped to 0
    assert p[4] == 0.0  # first seen in the previous month: not in that month's spine
    assert p[1] == 0.0
    p2 = {r.customer_id: r.probability for r in
          baseline_prob(rows, "2011-12", 300, include_new=True).collect()}
    assert p2[4] == 1.0


def test_small_group_statistics(spark):
    df = make_tx(spark, [
        ("1", "1", 5, "2011-01-01 00:00:00", 2.0, 1, "EIRE"),
        ("2", "1", 5, "2011-01-02 00:00:00", 2.0, 2, "EIRE"),
        ("3", "1", 5, "2011-01-03 00:00:00", 2.0, 2, "EIRE"),
        ("4", "1", 5, "2011-01-04 00:00:00", 2.0, 3, "EIRE"),
        ("5", "1", 5, "2011-01-05 00:00:00", 2.0, 3, "EIRE"),
        ("6", "1", 5, "2011-01-06 00:00:00", 2.0, 3, "EIRE"),
        ("7", "1", None, "2011-01-06 00:00:00", 2.0, 4, "EIRE"),
        ("8", "1", 1, "2011-01-01 00:00:00", 1.0, 5, "EIRE"),
        ("9", "1", 2, "2011-01-02 00:00:00", 1.0, 5, "EIRE"),
        ("10", "1", 10, "2011-01-03 00:00:00", 1.0, 5, "EIRE"),
        ("11", "1", 20, "2011-01-04 00:00:00", 1.0, 5, "EIRE"),
    ])
    out = {r.customer_id: r for r in st.stat_features(df, ["quantity"]).collect()}
    g = lambda c, s: out[c][f"quantity-{s}"]
    assert g(1, "std") is None and g(1, "skew") is None        # one value
    assert g(2, "std") == 0.0 and g(2, "skew") is None         # two values
    assert g(3, "std") == 0.0 and g(3, "skew") == 0.0          # constant
    assert g(4, "sum") == 0 and g(4, "count") == 0 and g(4, "mean") is None  # all null
    # adjusted skew of 1, 2, 10, 20 equals pandas' bias-corrected G1
    assert g(5, "skew") == pytest.approx(pd.Series([1, 2, 10, 20]).skew())
    assert g(5, "std") == pytest.approx(pd.Series([1, 2, 10, 20]).std())
    assert g(5, "mean") == 8.25


def test_first_last_skip_nulls(spark):
    df = make_tx(spark, [
        ("1", "1", 1, "2011-01-01 00:00:00", 1.0, 1, "France"),
        ("2", "1", 1, "2011-01-02 00:00:00", 1.0, 1, "Atlantis"),
    ]).withColumn("eu", F.when(F.col("country") == "France", 1))
    r = st.first_last(df.withColumn("order_ts", F.lit(1.0)), last=("eu", "country")).collect()[0]
    assert r["eu-last"] == 1 and r["country-last"] == "Atlantis"


def test_outliers_and_suspects(spark):
    df = make_tx(spark, [
        ("1", "ADJUST", 1, "2011-01-01 00:00:00", 1.0, 1, "EIRE"),
        ("2", "M", 1, "2011-01-01 00:00:00", 1.0, 1, "EIRE"),
        ("3", "85123A", 1, "2011-01-01 00:00:00", 1.0, 2, "EIRE"),
        ("4", "POST", 1, "2011-01-01 00:00:00", 1.0, 2, "EIRE"),
        ("5", "TEST001", 1, "2011-01-01 00:00:00", 1.0, 3, "EIRE"),
    ])
    assert {r.customer_id for r in an.outlier_customers(df, 20).collect()} == {1, 3}
    assert {r.customer_id for r in an.outlier_customers(df, 2).collect()} == {3}
    assert [r.customer_id for r in an.small_history_suspects(df, 2).collect()] == [1, 2, 3]
    codes = an.product_anomalies(df)
    assert {r.product_id for r in codes.collect()} == {"ADJUST", "M", "POST", "TEST001"}
    assert {r.customer_id for r in an.customers_with(df, codes).collect()} == {1, 2, 3}
    assert an.order_id_anomalies(df).collect()[0].n_anomalies == 0


def test_first_seen_code_and_eu(spark):
    df = make_tx(spark, [
        ("2", "1", 1, "2011-01-02 00:00:00", 1.0, 1, "France"),
        ("1", "1", 1, "2011-01-01 00:00:00", 1.0, 1, "Nowhere"),
        ("3", "1", 1, "2011-01-01 00:00:00", 1.0, 2, "EIRE"),
    ])
    codes = {r.country: r.country_code for r in lk.first_seen_code(df, "country").collect()}
    assert codes == {"Nowhere": 0, "EIRE": 1, "France": 2}
    eu = {r.country: r.eu for r in lk.eu_flag(df).collect()}
    assert eu == {"France": 1, "EIRE": 1, "Nowhere": None}


def test_medians_and_impute(spark):
    train = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None), (3, 10.0, None), (4, 20.0, None)],
                                  "customer_id long, a double, b double")
    test = spark.createDataFrame([(5, None, None)], "customer_id long, a double, b double")
    med = {r.feature: r.median for r in pr.fit_medians(train, ["a", "b"], method="chunked").collect()}
    assert med == {"a": 6.0, "b": None}
    _, te, _ = pr.impute_median(train, test, ["a", "b"])
    r = te.collect()[0]
    assert (r.a, r.b) == (6.0, 0.0)


def test_median_and_quantile_of_tied_values(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 990, 7.0).otherwise(F.col("id").cast("double")).alias("x"),
                                    (F.col("id") % 2).cast("double").alias("y"))
    assert {r.feature: r.median for r in pr.fit_medians(rows, ["x", "y"]).collect()} == {"x": 7.0, "y": 0.5}
    assert ex.quantile(rows, "x", 0.5).first()[0] == 7.0
    assert ex.quantile(rows, "x", 0.995).first()[0] == pytest.approx(994.005)
    assert ex.quantile(rows, "y", 0.5).first()[0] == 0.5
    assert ex.quantile(rows.where("x < 0"), "x", 0.5).first()[0] is None


def test_label_encode_unseen_test_value(spark):
    tr = spark.createDataFrame([("b",), ("a",)], "c string")
    te = spark.createDataFrame([("z",), ("a",)], "c string")
    a, b = pr.label_encode(tr, te, ["c"])
    assert sorted(r.c for r in a.collect()) == [0, 1]
    assert sorted(r.c for r in b.collect()) == [0, 2]


def _brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    pairs = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1), (0.4, 0), (0.0, 0), (0.9, 1)]
    df = spark.createDataFrame([(s, y) for s, y in pairs], "probability double, label int")
    for method in ("window", "chunked"):
        got = ev.auc(df, method=method).collect()[0].auc
        assert got == pytest.approx(_brute_auc(pairs))


def test_stratified_folds_balanced(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(1, 701)], "customer_id long, label int")
    folds = ev.stratified_folds(df, k=10, method="chunked")
    counts = folds.groupBy("fold", "label").count().collect()
    per_label = {}
    for r in counts:
        per_label.setdefault(r.label, []).append(r["count"])
    for v in per_label.values():
        assert len(v) == 10 and max(v) - min(v) <= 1
    assert folds.count() == 700 and folds.select("customer_id").distinct().count() == 700


def test_importance_tables(spark):
    fi = spark.createDataFrame([("a", 0, 3.0), ("b", 0, 1.0), ("a", 1, 1.0), ("c", 1, 4.0)],
                               "feature string, fold int, importance double")
    mean = {r.feature: r.importance for r in ev.mean_importance(fi).collect()}
    assert mean == {"a": 2.0, "b": 0.5, "c": 2.0}  # a fold without the feature counts as 0
    outer = {r.feature: (r.fold_1, r.fold_2) for r in ev.combine_importances(fi, "outer").collect()}
    assert outer == {"a": (3.0, 1.0), "b": (1.0, 0.0), "c": (0.0, 4.0)}
    assert [r.feature for r in ev.combine_importances(fi, "inner").collect()] == ["a"]
    norm = ev.normalize_importance(ev.mean_importance(fi)).orderBy(F.desc("importance"), "feature").collect()
    assert [r.feature for r in norm] == ["a", "c", "b"]
    assert norm[-1].cumulative_importance == pytest.approx(1.0)
    assert [r.feature for r in ev.top_features(ev.mean_importance(fi), 2).collect()] == ["a", "c"]


def test_term_counts_and_quantile(spark):
    df = make_tx(spark, [
        ("1", "1", 1, "2011-01-01 00:00:00", 1.0, 1, "EIRE"),
        ("2", "1", 2, "2011-01-01 00:00:00", 2.0, 2, "EIRE"),
        ("3", "1", 10, "2011-01-01 00:00:00", 1.0, 3, "EIRE"),
        ("4", "1", 20, "2011-01-01 00:00:00", 1.0, 4, "EIRE"),
    ])
    terms = {r.term: r.n for r in ex.term_counts(df).collect()}
    assert terms == {"item": 4}  # "1" is not a word
    q = ex.quantile(ex.spend_by_customer(df), "total", 0.999).collect()[0].quantile
    assert q == pytest.approx(19.97)


def test_null_months_and_missing_orders(spark):
    rows = [("o1", "P", 1, None, 5.0, 1, "EIRE"), ("o2", "P", 1, "2010-01-05 10:00:00", 2.0, 1, "EIRE")]
    tx = make_tx(spark, [r if r[3] else (*r[:3], "2010-01-01 00:00:00", *r[4:]) for r in rows])
    tx = tx.withColumn("order_date", F.expr("if(order_id = 'o1', null, order_date)"))
    assert [r.year_month for r in ex.spend_by_month(tx).collect()] == ["2010-01"]
    assert [r.year_month for r in ex.mean_by_month(tx).collect()] == ["2010-01"]
    assert [r.year_month for r in ex.spend_by_customer_month(tx).collect()] == ["2010-01"]


def test_csv_with_quotes_and_newlines(spark, tmp_path):
    path = tmp_path / "lines.csv"
    names = [f.name for f in TRANSACTIONS_SCHEMA.fields]
    values = {"order_id": "1", "product_id": "2", "description": '"DOORMAT ""NEW YORK"", LARGE\nTWO"', "quantity": "3",
              "order_date": "2010-01-05 10:00:00", "price": "1.50", "customer_id": "13085", "country": "EIRE", "total": "4.50"}
    path.write_text(",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    row = read_transactions(spark, str(path)).collect()[0]
    assert row.description == 'DOORMAT "NEW YORK", LARGE\nTWO' and row.quantity == 3 and row.customer_id == 13085
