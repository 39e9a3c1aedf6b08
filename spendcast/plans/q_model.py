"""Queries: folds, AUC, encoding, imputation, model fits, sinks.

Model outputs (fits, OOF predictions, importances) depend on the trainer
and have no SQL twin: they are registered without oracle SQL and covered by
invariant tests instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.functions.codes import product_prefix
from spendcast.functions.periods import history_before, in_month, prev_month
from spendcast.operators import evaluate as ev
from spendcast.operators import explore as ex
from spendcast.operators import features as fe
from spendcast.operators import model as mo
from spendcast.operators import prepare as pr
from spendcast.operators.labels import baseline_prob, customer_spine, month_label
from spendcast.plans.q_features import feature_sql, round_moments
from spendcast.operators.scan import materialize
from spendcast.plans.base import MAX_ROWS, MONTH, PREV_MONTH, THR, register, tx, with_tx
from spendcast.sources import sinks
from spendcast.sources.transactions import TEMPLATE_SCHEMA, read_template

K_FOLDS = 10
SEED = 42

_LABEL = """SELECT s.customer_id, s.year_month, CAST(COALESCE(t.total, 0) > {thr} AS INTEGER) AS label
FROM (SELECT DISTINCT customer_id, '{m}' AS year_month FROM transactions
      WHERE order_date < TIMESTAMP '{m}-01' AND customer_id IS NOT NULL) s
LEFT JOIN (SELECT customer_id, SUM(total) AS total FROM transactions
           WHERE strftime(order_date, '%Y-%m') = '{m}' GROUP BY customer_id) t
  ON s.customer_id = t.customer_id"""

_PROB = """SELECT cur.customer_id,
       LEAST(GREATEST(CAST(COALESCE(prev.total, 0) AS DOUBLE) / {thr}, 0.0), 1.0) AS probability
FROM ({cur}) cur LEFT JOIN (SELECT s.customer_id, t.total FROM
  (SELECT DISTINCT customer_id FROM transactions WHERE order_date < TIMESTAMP '{pm}-01' AND customer_id IS NOT NULL) s
  LEFT JOIN (SELECT customer_id, SUM(total) AS total FROM transactions
             WHERE strftime(order_date, '%Y-%m') = '{pm}' GROUP BY customer_id) t ON s.customer_id = t.customer_id) prev
  ON cur.customer_id = prev.customer_id"""

_FOLDS = (f"SELECT customer_id, label, CAST((ROW_NUMBER() OVER (PARTITION BY label ORDER BY "
          f"md5('{SEED}-' || CAST(customer_id AS VARCHAR)), customer_id) - 1) % {K_FOLDS} AS INTEGER) AS fold "
          f"FROM labels_m")

_AUC = """SELECT {by_sel} CAST(SUM(2 * pos * (cum_neg - neg) + pos * neg) AS DOUBLE)
       / NULLIF(2.0 * CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE), 0) AS auc
FROM (SELECT *, SUM(neg) OVER ({part} ORDER BY probability ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
      FROM (SELECT {by_sel} probability, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored
            GROUP BY {by_grp} probability))
{group}"""


def _scored_ctes(with_folds: bool) -> str:
    ctes = (f"labels_m AS ({_LABEL.format(m=MONTH, thr=THR)}),\n"
            f"probs AS ({_PROB.format(thr=float(THR), cur=_LABEL.format(m=MONTH, thr=THR), pm=PREV_MONTH)})")
    if with_folds:
        ctes += f",\nfolds AS ({_FOLDS}),\nscored AS (SELECT f.fold, f.label, p.probability FROM folds f " \
                f"JOIN probs p ON f.customer_id = p.customer_id)"
    else:
        ctes += ",\nscored AS (SELECT l.label, p.probability FROM labels_m l JOIN probs p " \
                "ON l.customer_id = p.customer_id)"
    return ctes


def _scored(spark, sf_dir) -> DataFrame:
    df = tx(spark, sf_dir)
    labels = month_label(df, MONTH, THR, sort=False).select("customer_id", "label")
    return labels.join(baseline_prob(df, MONTH, THR), "customer_id")


@register("stratified_folds", with_tx(f"SELECT * FROM ({_FOLDS})",
                                      f"labels_m AS ({_LABEL.format(m=MONTH, thr=THR)})"))
def q_stratified_folds(spark, sf_dir):
    labels = month_label(tx(spark, sf_dir), MONTH, THR, sort=False).select("customer_id", "label")
    return ev.stratified_folds(labels, "label", K_FOLDS, SEED)


@register("auc_baseline", with_tx(_AUC.format(by_sel="", by_grp="", part="", group=""),
                                  _scored_ctes(False)))
def q_auc_baseline(spark, sf_dir):
    return ev.auc(_scored(spark, sf_dir))


@register("fold_auc", with_tx(_AUC.format(by_sel="fold,", by_grp="fold,", part="PARTITION BY fold",
                                          group="GROUP BY fold"), _scored_ctes(True)))
def q_fold_auc(spark, sf_dir):
    folded = ev.stratified_folds(_scored(spark, sf_dir), "label", K_FOLDS, SEED)
    return ev.auc(folded, by=["fold"])


@register("mean_fold_auc", with_tx(
    "SELECT AVG(auc) AS mean_auc FROM (" + _AUC.format(
        by_sel="fold,", by_grp="fold,", part="PARTITION BY fold", group="GROUP BY fold") + ")",
    _scored_ctes(True)))
def q_mean_fold_auc(spark, sf_dir):
    folded = ev.stratified_folds(_scored(spark, sf_dir), "label", K_FOLDS, SEED)
    return ev.mean_fold_auc(folded).select(F.col("mean_auc"))


_NORM = ("CASE WHEN NOT regexp_full_match(product_id, '[0-9]+') AND NOT regexp_full_match(product_id, '[A-Za-z]+') "
         "THEN substring(product_id, 1, length(product_id) - 1) ELSE product_id END")


@register("label_encode", with_tx(
    """SELECT r.split, r.order_id, r.line_seq,
              CAST(c.code AS INTEGER) AS country, CAST(p.code AS INTEGER) AS product_prefix
       FROM rows_ r
       JOIN (SELECT country, DENSE_RANK() OVER (ORDER BY country) - 1 AS code
             FROM (SELECT DISTINCT country FROM rows_)) c ON r.country = c.country
       JOIN (SELECT product_prefix, DENSE_RANK() OVER (ORDER BY product_prefix) - 1 AS code
             FROM (SELECT DISTINCT product_prefix FROM rows_)) p ON r.product_prefix = p.product_prefix""",
    f"""rows_ AS (
       SELECT 'train' AS split, order_id, line_seq, country, substring({_NORM}, 1, 3) AS product_prefix
       FROM transactions WHERE order_date < TIMESTAMP '{PREV_MONTH}-01'
       UNION ALL
       SELECT 'test' AS split, order_id, line_seq, country, substring({_NORM}, 1, 3) AS product_prefix
       FROM transactions WHERE strftime(order_date, '%Y-%m') = '{PREV_MONTH}')"""))
def q_label_encode(spark, sf_dir):
    df = tx(spark, sf_dir).select("order_id", "line_seq", "country", "order_date",
                                  product_prefix("product_id").alias("product_prefix"))
    train = history_before(df, PREV_MONTH).withColumn("split", F.lit("train"))
    test = in_month(df, PREV_MONTH).withColumn("split", F.lit("test"))
    tr, te = pr.label_encode(train, test, ["country", "product_prefix"])
    cols = ["split", "order_id", "line_seq", "country", "product_prefix"]
    return tr.select(*cols).unionByName(te.select(*cols))


def _datasets(spark, sf_dir):
    """Training and scoring sets, moments rounded as the SQL rounds them; the
    model fits read them unrounded."""
    train, test, _ = fe.build_datasets(tx(spark, sf_dir), MONTH, THR, MAX_ROWS)
    return round_moments(train), round_moments(test)


_NAMES = ", ".join(f"('{n}')" for n in fe.FEATURE_NAMES)
_TRAIN_FEATS = f"train_f AS (SELECT f.* FROM labels_p l JOIN feats_tr f ON l.customer_id = f.customer_id)"


@register("fit_medians", with_tx(
    "SELECT n.feature, m.median FROM (VALUES " + _NAMES + ") n(feature) LEFT JOIN "
    "(SELECT feature, MEDIAN(value) AS median FROM (UNPIVOT train_f ON COLUMNS(* EXCLUDE customer_id) "
    "INTO NAME feature VALUE value) WHERE NOT isnan(value) GROUP BY feature) m ON n.feature = m.feature",
    f"labels_p AS ({_LABEL.format(m=PREV_MONTH, thr=THR)}),\n"
    + feature_sql(prev_month(MONTH), sfx="_tr") + ",\n" + _TRAIN_FEATS))
def q_fit_medians(spark, sf_dir):
    train = fe.training_set(tx(spark, sf_dir), MONTH, THR, max_rows=MAX_ROWS)
    return pr.fit_medians(round_moments(train), list(fe.FEATURE_NAMES))


_MEDS = "meds AS (SELECT " + ", ".join(f'MEDIAN("{n}") AS "{n}"' for n in fe.FEATURE_NAMES) + " FROM train_f)"


@register("impute_median", with_tx(
    "SELECT l.customer_id, l.year_month, l.label, "
    + ", ".join(f'COALESCE(f."{n}", m."{n}", 0.0) AS "{n}"' for n in fe.FEATURE_NAMES)
    + f" FROM ({_LABEL.format(m=MONTH, thr=THR)}) l LEFT JOIN feats_te f ON l.customer_id = f.customer_id"
    " CROSS JOIN meds m",
    f"labels_p AS ({_LABEL.format(m=PREV_MONTH, thr=THR)}),\n"
    + feature_sql(prev_month(MONTH), sfx="_tr") + ",\n" + feature_sql(MONTH, sfx="_te") + ",\n"
    + _TRAIN_FEATS + ",\n" + _MEDS))
def q_impute_median(spark, sf_dir):
    train, test = _datasets(spark, sf_dir)
    _, test_i, _ = pr.impute_median(train, test, list(fe.FEATURE_NAMES), stored=True)
    return test_i


def _model_inputs(spark, sf_dir):
    train, test, _ = fe.build_datasets(tx(spark, sf_dir), MONTH, THR, MAX_ROWS)
    train_i, test_i, _ = pr.impute_median(train, test, list(fe.FEATURE_NAMES), stored=True)
    return train_i, test_i


@register("fit_predict")
def q_fit_predict(spark, sf_dir):
    train, test = _model_inputs(spark, sf_dir)
    preds, _ = mo.fit_predict(train, test, list(fe.FEATURE_NAMES),
                              mo.default_estimator(seed=SEED))
    return preds


def _oof(spark, sf_dir):
    """Out-of-fold training on the fixture: 10 folds, up to 100 trees each,
    stopped early on the held-out fold."""
    train, test = _model_inputs(spark, sf_dir)
    return mo.oof_predict(train, test, list(fe.FEATURE_NAMES), mo.default_estimator(seed=SEED),
                          k=K_FOLDS, seed=SEED, early_stopping=True)


@register("oof_predict")
def q_oof_predict(spark, sf_dir):
    oof, _, _ = _oof(spark, sf_dir)
    return oof


@register("oof_importance")
def q_oof_importance(spark, sf_dir):
    _, _, fi = _oof(spark, sf_dir)
    return fi


@register("oof_auc")
def q_oof_auc(spark, sf_dir):
    """AUC of the fitted models: mean over the folds, and over all rows."""
    oof = materialize(_oof(spark, sf_dir)[0])
    return ev.mean_fold_auc(oof).select("mean_auc", ev.auc(oof).select("auc").scalar().alias("oof_auc"))


@register("model_submission")
def q_model_submission(spark, sf_dir):
    """Features, imputation, out-of-fold models, mean prediction, submission."""
    _, test_mean, _ = _oof(spark, sf_dir)
    path = sinks.scratch_path(spark, "model-submission")
    sinks.write_submission(customer_spine(tx(spark, sf_dir), MONTH).select("customer_id"), test_mean, path)
    return sinks.read_dataset(spark, path, TEMPLATE_SCHEMA, "csv")


# The tables after a fit have plain SQL twins: these queries read fold tables
# made from the order lines.  Binary fractions, so sums do not depend on order.
FOLDS_READ = 8
_PREDS = ("preds AS (SELECT customer_id, month(order_date) % 8 AS fold, "
          "CAST(ABS(SUM(quantity)) % 256 AS DOUBLE) / 256 AS probability FROM transactions "
          "WHERE customer_id IS NOT NULL GROUP BY 1, 2)")
_FI = (f"fi AS (SELECT substring({_NORM}, 1, 3) AS feature, customer_id % {FOLDS_READ} AS fold, "
       "CAST(SUM(quantity) AS DOUBLE) / 64 AS importance FROM transactions "
       "WHERE customer_id IS NOT NULL AND product_id IS NOT NULL GROUP BY 1, 2),\n"
       "mean_fi AS (SELECT feature, SUM(importance) / (SELECT COUNT(DISTINCT fold) FROM fi) AS importance "
       "FROM fi GROUP BY feature)")


def _fold_importances(spark, sf_dir) -> DataFrame:
    """(feature, fold, importance): units of each product family by customer fold."""
    known = tx(spark, sf_dir).where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    return known.groupBy(product_prefix("product_id").alias("feature"),
                         (F.col("customer_id") % FOLDS_READ).cast("int").alias("fold")).agg(
        (F.sum("quantity").cast("double") / 64).alias("importance"))


@register("fold_mean", with_tx("SELECT customer_id, AVG(probability) AS probability FROM preds GROUP BY customer_id", _PREDS))
def q_fold_mean(spark, sf_dir):
    preds = tx(spark, sf_dir).where(F.col("customer_id").isNotNull()).groupBy(
        "customer_id", (F.month("order_date") % 8).alias("fold")).agg(
        ((F.abs(F.sum("quantity")) % 256).cast("double") / 256).alias("probability"))
    return ev.fold_mean(preds)


@register("importance_folds", with_tx(
    "SELECT f.*, m.importance FROM (SELECT feature, " + ", ".join(
        f"COALESCE(MAX(importance) FILTER (WHERE fold = {i}), 0.0) AS fold_{i + 1}" for i in range(FOLDS_READ))
    + " FROM fi GROUP BY feature) f JOIN mean_fi m USING (feature)", _FI))
def q_importance_folds(spark, sf_dir):
    """Per-fold importances side by side with their mean, ascending."""
    fi = _fold_importances(spark, sf_dir)
    wide = ev.combine_importances(fi, "outer").join(ev.mean_importance(fi), "feature")
    return ev.sort_importance(wide)


@register("importance_cumulative", with_tx(
    "SELECT feature, importance, importance_normalized, ROUND(SUM(importance_normalized) OVER "
    "(ORDER BY importance DESC, feature ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS cumulative_importance "
    "FROM (SELECT *, importance / (SELECT SUM(importance) FROM mean_fi) AS importance_normalized FROM mean_fi)", _FI))
def q_importance_cumulative(spark, sf_dir):
    out = ev.normalize_importance(ev.mean_importance(_fold_importances(spark, sf_dir)))
    return out.withColumn("cumulative_importance", F.round("cumulative_importance", 9))


@register("top_features", with_tx("SELECT feature, importance FROM mean_fi ORDER BY importance DESC, feature LIMIT 20", _FI))
def q_top_features(spark, sf_dir):
    return ev.top_features(ev.mean_importance(_fold_importances(spark, sf_dir)), 20)


@register("submission", with_tx(
    f"SELECT s.customer_id, p.probability FROM (SELECT DISTINCT customer_id FROM transactions "
    f"WHERE order_date < TIMESTAMP '{MONTH}-01' AND customer_id IS NOT NULL) s LEFT JOIN ("
    + _PROB.format(thr=float(THR), cur=_LABEL.format(m=MONTH, thr=THR), pm=PREV_MONTH)
    + ") p ON s.customer_id = p.customer_id"))
def q_submission(spark, sf_dir):
    df = tx(spark, sf_dir)
    tpl_path = sinks.scratch_path(spark, "template")
    sinks.write_dataset(customer_spine(df, MONTH).select("customer_id"), tpl_path, "csv")
    out_path = sinks.scratch_path(spark, "submission")
    sinks.write_submission(read_template(spark, tpl_path), baseline_prob(df, MONTH, THR), out_path)
    return sinks.read_dataset(spark, out_path, TEMPLATE_SCHEMA, "csv")


@register("dataset_roundtrip", with_tx(
    "SELECT customer_id, strftime(order_date, '%Y-%m-%d') AS year_month_day, order_id, product_id, "
    "description, quantity, price, country, total FROM transactions"))
def q_dataset_roundtrip(spark, sf_dir):
    rows = ex.dataset_project(tx(spark, sf_dir))
    path = sinks.scratch_path(spark, "dataset")
    sinks.write_dataset(rows, path, "csv")
    return sinks.read_dataset(spark, path, rows.schema, "csv")
