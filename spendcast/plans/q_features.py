"""Queries: running sums, differences, per-customer statistics, the feature
matrix and the training / scoring sets.

Standard deviations are rounded to 4 and skewness to 6 decimals on both
sides of the oracle check: they are sums of doubles whose order differs
between engines.  Everything else is exact (decimal sums, one division).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.functions.codes import product_prefix
from spendcast.functions.lookups import EU_FLAG, eu_flag
from spendcast.functions.periods import add_months, epoch_seconds, history_before, prev_month
from spendcast.operators import features as fe
from spendcast.operators import partials as pt
from spendcast.operators import sketches as sk
from spendcast.operators import stats as st
from spendcast.operators.running import row_diffs, running_sums
from spendcast.plans.base import MAX_ROWS, MONTH, PREV_MONTH, THR, register, tx, with_tx
from spendcast.sources import sinks
from spendcast.sources.transactions import order_cols

ORD = "order_date, order_id, line_seq"
_NORM = ("CASE WHEN NOT regexp_full_match(product_id, '[0-9]+') AND NOT regexp_full_match(product_id, '[A-Za-z]+') "
         "THEN substring(product_id, 1, length(product_id) - 1) ELSE product_id END")
_EU_CASE = "CASE " + " ".join(f"WHEN country = '{k}' THEN {v}" for k, v in EU_FLAG.items()) + " END"


def _run(part: str) -> str:
    return f"(PARTITION BY {part} ORDER BY {ORD} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _enriched_ctes(as_of: str | None, sfx: str = "") -> str:
    where = f"WHERE order_date < TIMESTAMP '{as_of}-01'" if as_of else ""
    sums = []
    for part, spec in (("customer_id", fe.CUST_SUMS), ("product_prefix", fe.PROD_SUMS),
                       ("order_id", fe.ORDER_SUMS)):
        for out, src in spec.items():
            sums.append(f"CASE WHEN {src} IS NULL THEN NULL ELSE SUM({src}) OVER {_run(part)} END AS {out}")
    diffs = [f"{src} - LAG({src}) OVER (PARTITION BY customer_id ORDER BY {ORD}) AS {out}"
             for out, src in fe.DIFFS.items()]
    return f"""base{sfx} AS (
  SELECT order_id, product_id, quantity, order_date, price, customer_id, country, total, line_seq,
         substring({_NORM}, 1, 3) AS product_prefix,
         CAST(CASE WHEN product_id = 'POST' THEN GREATEST(total, 0) ELSE 0 END AS DECIMAL(18,2)) AS post,
         CAST({_EU_CASE} AS INTEGER) AS eu,
         CAST(epoch(order_date) AS DOUBLE) AS order_ts
  FROM transactions {where}),
enriched{sfx} AS (
  SELECT *, {", ".join(sums + diffs)} FROM base{sfx})"""


def _stat_sql(c: str, s: str) -> str:
    if s == "mean":
        return f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})"
    if s in ("max", "min"):
        return f"CAST({s.upper()}({c}) AS DOUBLE)"
    if s == "sum":
        return f"CAST(COALESCE(SUM({c}), 0) AS DOUBLE)"
    if s == "count":
        return f"CAST(COUNT({c}) AS DOUBLE)"
    if s == "std":
        return f"ROUND(STDDEV_SAMP({c}), 4)"
    if s == "skew":
        return (f"ROUND(CASE WHEN COUNT({c}) < 3 THEN NULL WHEN STDDEV_SAMP({c}) = 0 THEN 0 "
                f"ELSE SKEWNESS({c}) END, 6)")
    if s == "first":
        return f"CAST(arg_min({c}, ({ORD})) FILTER (WHERE {c} IS NOT NULL) AS DOUBLE)"
    if s == "last":
        return f"CAST(arg_max({c}, ({ORD})) FILTER (WHERE {c} IS NOT NULL) AS DOUBLE)"
    if s == "nunique":
        return f"CAST(COUNT(DISTINCT {c}) AS DOUBLE)"
    raise ValueError(s)


def feature_sql(as_of: str, max_rows: int = MAX_ROWS, sfx: str = "") -> str:
    """DuckDB CTEs ending in ``feats`` (customer_id + 124 features)."""
    cols = []
    for c, stats in fe.FEATURE_SPEC:
        for s in stats:
            name = f'"{c}-{s}"'
            if c == "country_code":
                cols.append(f"CAST(k.country_code AS DOUBLE) AS {name}")
            elif c == "outlier":
                cols.append(f"CAST(CASE WHEN a._n < {max_rows} AND NOT regexp_full_match(substring(a._min_code, 1, 5), "
                            f"'[0-9]+') THEN 1 ELSE 0 END AS DOUBLE) AS {name}")
            else:
                cols.append(f"a.{name}")
    agg = []
    for c, stats in fe.FEATURE_SPEC:
        if c in ("country_code", "outlier"):
            continue
        src = "product_prefix" if c == "product_id" else c
        agg += [f'{_stat_sql(src, s)} AS "{c}-{s}"' for s in stats]
    return f"""{_enriched_ctes(as_of, sfx)},
codes{sfx} AS (
  SELECT country, ROW_NUMBER() OVER (ORDER BY f, country) - 1 AS country_code
  FROM (SELECT country, MIN(({ORD})) AS f FROM enriched{sfx} WHERE country IS NOT NULL GROUP BY country)),
agg{sfx} AS (
  SELECT customer_id, {", ".join(agg)},
         arg_max(country, ({ORD})) FILTER (WHERE country IS NOT NULL) AS _last_country,
         COUNT(*) AS _n, MIN(product_id) AS _min_code
  FROM enriched{sfx} WHERE customer_id IS NOT NULL GROUP BY customer_id),
feats{sfx} AS (
  SELECT a.customer_id, {", ".join(cols)} FROM agg{sfx} a LEFT JOIN codes{sfx} k ON a._last_country = k.country)"""


def round_moments(df: DataFrame) -> DataFrame:
    """Round ``*-std`` to 4 and ``*-skew`` to 6 decimals (for the check)."""
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c.endswith("-std"):
            col = F.round(col, 4)
        elif c.endswith("-skew"):
            col = F.round(col, 6)
        out.append(col.alias(c))
    return df.select(*out)


def _sum_cols(spec: dict) -> list:
    return [F.col(o).cast("bigint" if spec[o] == "quantity" else "decimal(38,2)").alias(o) for o in spec]


def _sum_sql(spec: dict) -> str:
    return ", ".join(f"CAST({o} AS {'BIGINT' if s == 'quantity' else 'DECIMAL(38,2)'}) AS {o}"
                     for o, s in spec.items())


_ROW = ["order_id", "line_seq"]


def _prepared(spark, sf_dir) -> DataFrame:
    """Fixture rows with the row-level columns the scans read."""
    df = tx(spark, sf_dir)
    return df.select("*", product_prefix("product_id").alias("product_prefix"),
                     st.post_amount("product_id").alias("post"),
                     eu_flag("country").alias("eu"), epoch_seconds().alias("order_ts"))


@register("cumsum_customer", with_tx(
    f"SELECT order_id, line_seq, {_sum_sql({k: v for k, v in fe.CUST_SUMS.items() if v != 'post'})} FROM enriched",
    _enriched_ctes(None)))
def q_cumsum_customer(spark, sf_dir):
    spec = {k: v for k, v in fe.CUST_SUMS.items() if v != "post"}
    out = running_sums(_prepared(spark, sf_dir), "customer_id", spec, order_cols(), keep=_ROW)
    return out.select("order_id", "line_seq", *_sum_cols(spec))


@register("cumsum_post", with_tx(
    "SELECT order_id, line_seq, CAST(post AS DECIMAL(38,2)) AS post, "
    "CAST(cumsum_post_by_cust_id AS DECIMAL(38,2)) AS cumsum_post_by_cust_id FROM enriched",
    _enriched_ctes(None)))
def q_cumsum_post(spark, sf_dir):
    spec = {"cumsum_post_by_cust_id": "post"}
    out = running_sums(_prepared(spark, sf_dir), "customer_id", spec, order_cols(), keep=[*_ROW, "post"])
    return out.select("order_id", "line_seq", F.col("post").cast("decimal(38,2)").alias("post"),
                      *_sum_cols(spec))


@register("cumsum_product", with_tx(
    f"SELECT order_id, line_seq, product_prefix, {_sum_sql(fe.PROD_SUMS)} FROM enriched",
    _enriched_ctes(None)))
def q_cumsum_product(spark, sf_dir):
    out = running_sums(_prepared(spark, sf_dir), "product_prefix", fe.PROD_SUMS, order_cols(), keep=[*_ROW, "product_prefix"])
    return out.select("order_id", "line_seq", "product_prefix", *_sum_cols(fe.PROD_SUMS))


@register("cumsum_order", with_tx(
    f"SELECT order_id, line_seq, {_sum_sql(fe.ORDER_SUMS)} FROM enriched", _enriched_ctes(None)))
def q_cumsum_order(spark, sf_dir):
    out = running_sums(_prepared(spark, sf_dir), "order_id", fe.ORDER_SUMS, order_cols(), keep=_ROW)
    return out.select("order_id", "line_seq", *_sum_cols(fe.ORDER_SUMS))


@register("row_diffs", with_tx(
    "SELECT order_id, line_seq, order_ts_diff, quantity_diff, "
    "CAST(price_diff AS DECIMAL(38,2)) AS price_diff, CAST(total_diff AS DECIMAL(38,2)) AS total_diff "
    "FROM enriched", _enriched_ctes(None)))
def q_row_diffs(spark, sf_dir):
    out = row_diffs(_prepared(spark, sf_dir), "customer_id", fe.DIFFS, keep=_ROW)
    return out.select("order_id", "line_seq", "order_ts_diff", "quantity_diff",
                      F.col("price_diff").cast("decimal(38,2)").alias("price_diff"),
                      F.col("total_diff").cast("decimal(38,2)").alias("total_diff"))


_STAT_COLS = ("quantity", "price", "total")


@register("stat_features", with_tx(
    "SELECT customer_id, " + ", ".join(f'{_stat_sql(c, s)} AS "{c}-{s}"' for c in _STAT_COLS
                                       for s in fe.SEVEN_STATS)
    + " FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id"))
def q_stat_features(spark, sf_dir):
    out = st.stat_features(tx(spark, sf_dir), _STAT_COLS)
    return round_moments(out.select("customer_id", *[F.col(f"`{c}`").cast("double").alias(c)
                                                     for c in out.columns[1:]]))


@register("adj_skew", with_tx(
    "SELECT customer_id, " + ", ".join(f'{_stat_sql(c, "skew")} AS "{c}-skew"' for c in _STAT_COLS)
    + " FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id"))
def q_adj_skew(spark, sf_dir):
    return round_moments(st.stat_features(tx(spark, sf_dir), _STAT_COLS, stats=("skew",)))


@register("distinct_counts", with_tx(
    f"SELECT customer_id, COUNT(DISTINCT order_id) AS \"order_id-nunique\", "
    f"COUNT(DISTINCT product_prefix) AS \"product_id-nunique\" FROM enriched "
    f"WHERE customer_id IS NOT NULL GROUP BY customer_id", _enriched_ctes(None)))
def q_distinct_counts(spark, sf_dir):
    return st.distinct_counts(_prepared(spark, sf_dir))


@register("first_last", with_tx(
    f"SELECT customer_id, {_stat_sql('order_ts', 'first')} AS \"order_ts-first\", "
    f"{_stat_sql('order_ts', 'last')} AS \"order_ts-last\", "
    f"arg_max(country, ({ORD})) FILTER (WHERE country IS NOT NULL) AS \"country-last\", "
    f"arg_max(eu, ({ORD})) FILTER (WHERE eu IS NOT NULL) AS \"eu-last\" "
    f"FROM enriched WHERE customer_id IS NOT NULL GROUP BY customer_id", _enriched_ctes(None)))
def q_first_last(spark, sf_dir):
    return st.first_last(_prepared(spark, sf_dir))


@register("post_spend", with_tx(
    "SELECT customer_id, CAST(SUM(GREATEST(total, 0)) AS DOUBLE) AS post FROM transactions "
    "WHERE customer_id IS NOT NULL AND product_id = 'POST' GROUP BY customer_id"))
def q_post_spend(spark, sf_dir):
    return st.post_spend(tx(spark, sf_dir), "POST")


@register("feature_matrix", with_tx("SELECT * FROM feats", feature_sql(MONTH)))
def q_feature_matrix(spark, sf_dir):
    return round_moments(fe.feature_matrix(tx(spark, sf_dir), MONTH, max_rows=MAX_ROWS))


_LABEL = """SELECT s.customer_id, s.year_month, CAST(COALESCE(t.total, 0) > {thr} AS INTEGER) AS label
FROM (SELECT DISTINCT customer_id, '{m}' AS year_month FROM transactions
      WHERE order_date < TIMESTAMP '{m}-01' AND customer_id IS NOT NULL) s
LEFT JOIN (SELECT customer_id, SUM(total) AS total FROM transactions
           WHERE strftime(order_date, '%Y-%m') = '{m}' GROUP BY customer_id) t
  ON s.customer_id = t.customer_id"""


@register("training_set", with_tx(
    f"SELECT l.*, f.* EXCLUDE (customer_id) FROM ({_LABEL.format(m=prev_month(MONTH), thr=THR)}) l "
    f"LEFT JOIN feats f ON l.customer_id = f.customer_id", feature_sql(prev_month(MONTH))))
def q_training_set(spark, sf_dir):
    return round_moments(fe.training_set(tx(spark, sf_dir), MONTH, THR, max_rows=MAX_ROWS))


def _months_sql(m: str, sfx: str) -> str:
    return (f"SELECT l.*, f.* EXCLUDE (customer_id) FROM ({_LABEL.format(m=m, thr=THR)}) l "
            f"LEFT JOIN feats{sfx} f ON l.customer_id = f.customer_id")


@register("training_set_months", with_tx(
    f"{_months_sql(prev_month(MONTH), '_a')} UNION ALL {_months_sql(prev_month(PREV_MONTH), '_b')}",
    feature_sql(prev_month(MONTH), sfx="_a") + ",\n" + feature_sql(prev_month(PREV_MONTH), sfx="_b")))
def q_training_set_months(spark, sf_dir):
    return round_moments(fe.training_sets(tx(spark, sf_dir), [PREV_MONTH, MONTH], THR, max_rows=MAX_ROWS))


@register("scoring_set", with_tx(
    f"SELECT l.*, f.* EXCLUDE (customer_id) FROM ({_LABEL.format(m=MONTH, thr=THR)}) l "
    f"LEFT JOIN feats f ON l.customer_id = f.customer_id", feature_sql(MONTH)))
def q_scoring_set(spark, sf_dir):
    return round_moments(fe.scoring_set(tx(spark, sf_dir), MONTH, THR, max_rows=MAX_ROWS))


_YEAR = [add_months(MONTH, -k) for k in range(12)]


@register("training_set_year", with_tx(
    " UNION ALL ".join(_months_sql(prev_month(m), f"_{k}") for k, m in enumerate(_YEAR)),
    ",\n".join(feature_sql(prev_month(m), sfx=f"_{k}") for k, m in enumerate(_YEAR))))
def q_training_set_year(spark, sf_dir):
    """Twelve cuts out of one pass over the rows."""
    return round_moments(fe.training_sets(tx(spark, sf_dir), _YEAR, THR, max_rows=MAX_ROWS))


_SHORT = [(c, s) for c in fe.STAT_COLUMNS for s in fe.SEVEN_STATS]


def _short_sql(which: str) -> str:
    """The short training form: statistics before the label's month, medians of the
    training set in place of missing values."""
    pm = prev_month(MONTH)
    parts = []
    for x, m in (("train", pm), ("score", MONTH)):
        aggs = ", ".join(f'{_stat_sql(c, s).replace("ROUND(", "(").replace(", 4)", ")").replace(", 6)", ")")} AS "{c}-{s}"' for c, s in _SHORT)
        parts.append(f"""{x} AS (SELECT l.*, f.* EXCLUDE (customer_id) FROM ({_LABEL.format(m=m, thr=THR)}) l
  LEFT JOIN (SELECT customer_id, {aggs} FROM transactions WHERE order_date < TIMESTAMP '{m}-01' GROUP BY customer_id) f
    ON l.customer_id = f.customer_id)""")
    digits = {"std": 4, "skew": 6}
    filled = ", ".join((f'ROUND({v}, {digits[s]})' if s in digits else v) + f' AS "{c}-{s}"'
                       for c, s in _SHORT for v in [f'COALESCE("{c}-{s}", (SELECT COALESCE(MEDIAN("{c}-{s}"), 0) FROM train))'])
    return with_tx(f"SELECT customer_id, year_month, label, {filled} FROM {which}", ", ".join(parts))


@register("stat_training_set", _short_sql("train"))
def q_stat_training_set(spark, sf_dir):
    return round_moments(fe.stat_datasets(tx(spark, sf_dir), MONTH, THR)[0])


@register("stat_scoring_set", _short_sql("score"))
def q_stat_scoring_set(spark, sf_dir):
    return round_moments(fe.stat_datasets(tx(spark, sf_dir), MONTH, THR)[1])


_QS = (0.01, 0.25, 0.5, 0.9, 0.99)


@register("quantile_sketch", with_tx(
    " UNION ALL ".join(f"SELECT CAST({q} AS DOUBLE) AS q, COUNT(total) AS n_rows, TRUE AS within_bound FROM transactions" for q in _QS)))
def q_quantile_sketch(spark, sf_dir):
    """Quantiles of line totals out of merged month sketches; the share of rows below and
    up to each is counted against the bound."""
    rows = tx(spark, sf_dir).withColumn("total", F.col("total").cast("double"))
    whole = sk.merge_quantiles(sk.quantile_sketches(rows.withColumn("m", pt.month_index()), ["m"], "total"))
    found = whole.select(F.struct(*[sk.sketch_quantile("sketch", q).alias(f"q{i}") for i, q in enumerate(_QS)])).scalar()
    below = rows.agg(F.count("total").alias("n"), *[F.count(F.when(op(F.col("total"), found.getField(f"q{i}")), 1)).alias(f"{x}{i}")
                                                    for i in range(len(_QS)) for x, op in (("lt", lambda a, b: a < b), ("le", lambda a, b: a <= b))])
    bound = sk.rank_bound()
    rank = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col("n").alias("n_rows"), (
        (F.col(f"lt{i}") <= (q + bound) * F.col("n")) & (F.col(f"le{i}") >= (q - bound) * F.col("n"))).alias("within_bound"))
        for i, q in enumerate(_QS)]))
    return below.select(rank.alias("r")).select("r.*")


@register("distinct_sketch", with_tx(
    'SELECT customer_id, COUNT(DISTINCT order_id) AS orders, TRUE AS within_bound FROM transactions '
    f"WHERE customer_id IS NOT NULL AND order_date < TIMESTAMP '{MONTH}-01' GROUP BY customer_id"))
def q_distinct_sketch(spark, sf_dir):
    """Orders per customer before a cut out of merged month sketches, against the exact count."""
    rows = history_before(tx(spark, sf_dir), MONTH).where("customer_id is not null")
    months = sk.distinct_sketches(rows.withColumn("m", pt.month_index()), ["customer_id", "m"], "order_id")
    found = sk.merge_distinct(months, ["customer_id"]).select("customer_id", F.hll_sketch_estimate("sketch").alias("estimate"))
    exact = rows.groupBy("customer_id").agg(F.count_distinct("order_id").alias("orders"))
    near = F.abs(F.col("estimate") - F.col("orders")) <= F.greatest(F.lit(sk.distinct_bound()) * F.col("orders"), F.lit(0.5))
    return exact.join(found, "customer_id").select("customer_id", "orders", near.alias("within_bound"))


@register("sorted_rows", with_tx("SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS inversions FROM transactions"))
def q_sorted_rows(spark, sf_dir):
    """Order lines written in the order of customer and order, and read back to prove it."""
    path = sinks.scratch_path(spark, "sorted-lines")
    keys = ["customer_id", "order_id"]
    sinks.write_sorted(tx(spark, sf_dir).select(*keys, "line_seq", "total"), path, keys)
    return sinks.sort_inversions(spark, path, keys).select("rows", "inversions")
