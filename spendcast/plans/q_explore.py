"""Queries: exploratory aggregates, anomalies, lookups, text."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendcast.functions.codes import normalize_product_id, product_prefix
from spendcast.functions.lookups import EU_FLAG
from spendcast.operators import anomalies as an
from spendcast.operators import explore as ex
from spendcast.operators import lookups as lk
from spendcast.plans.base import (BAND_THR, MAX_ROWS, PREV_MONTH, SUSPECT_N, TOP_Q, register,
                                      tx, with_tx)

_STOP = ", ".join(f"'{w}'" for w in ex.STOP_WORDS)
_ANOM = "NOT regexp_full_match(substring(product_id, 1, 5), '[0-9]+')"
_NORM = ("CASE WHEN NOT regexp_full_match(product_id, '[0-9]+') AND NOT regexp_full_match(product_id, '[A-Za-z]+') "
         "THEN substring(product_id, 1, length(product_id) - 1) ELSE product_id END")


@register("spend_by_customer", with_tx(
    "SELECT customer_id, CAST(SUM(total) AS DOUBLE) AS total FROM transactions "
    "WHERE customer_id IS NOT NULL GROUP BY customer_id"))
def q_spend_by_customer(spark, sf_dir):
    return ex.spend_by_customer(tx(spark, sf_dir))


@register("spend_by_month", with_tx(
    "SELECT strftime(order_date, '%Y-%m') AS year_month, CAST(SUM(total) AS DOUBLE) AS total "
    "FROM transactions GROUP BY 1"))
def q_spend_by_month(spark, sf_dir):
    return ex.spend_by_month(tx(spark, sf_dir))


@register("mean_by_month", with_tx(
    "SELECT strftime(order_date, '%Y-%m') AS year_month, "
    "CAST(SUM(total) AS DOUBLE) / COUNT(total) AS mean_total FROM transactions GROUP BY 1"))
def q_mean_by_month(spark, sf_dir):
    return ex.mean_by_month(tx(spark, sf_dir))


@register("customer_mean_in_month", with_tx(
    f"SELECT customer_id, CAST(SUM(total) AS DOUBLE) / COUNT(total) AS mean_total FROM transactions "
    f"WHERE strftime(order_date, '%Y-%m') = '{PREV_MONTH}' AND customer_id IS NOT NULL GROUP BY 1"))
def q_customer_mean_in_month(spark, sf_dir):
    return ex.customer_mean_in_month(tx(spark, sf_dir), PREV_MONTH)


@register("spend_by_customer_month", with_tx(
    "SELECT customer_id, strftime(order_date, '%Y-%m') AS year_month, "
    "CAST(SUM(total) AS DOUBLE) AS total_sum FROM transactions WHERE customer_id IS NOT NULL GROUP BY 1, 2"))
def q_spend_by_customer_month(spark, sf_dir):
    return ex.spend_by_customer_month(tx(spark, sf_dir))


@register("order_totals", with_tx(
    "SELECT order_id, SUM(total) AS order_total FROM transactions "
    "WHERE order_id IS NOT NULL GROUP BY order_id"))
def q_order_totals(spark, sf_dir):
    return ex.order_totals(tx(spark, sf_dir)).withColumn("order_total", F.col("order_total").cast("decimal(38,2)"))


@register("spend_by_customer_order", with_tx(
    "SELECT customer_id, order_id, CAST(SUM(total) AS DOUBLE) AS order_total FROM transactions "
    "WHERE customer_id IS NOT NULL AND order_id IS NOT NULL GROUP BY 1, 2"))
def q_spend_by_customer_order(spark, sf_dir):
    return ex.spend_by_customer_order(tx(spark, sf_dir))


@register("mean_of_order_means", with_tx(
    "SELECT customer_id, AVG(m) AS mean_order_mean FROM ("
    " SELECT customer_id, order_id, CAST(SUM(total) AS DOUBLE) / COUNT(total) AS m FROM transactions"
    " WHERE customer_id IS NOT NULL AND order_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1"))
def q_mean_of_order_means(spark, sf_dir):
    return ex.mean_of_order_means(tx(spark, sf_dir))


@register("order_value_bands", with_tx(
    f"SELECT COUNT(*) FILTER (WHERE t <= 0) AS n_nonpositive, COUNT(*) FILTER (WHERE t < {BAND_THR}) AS n_below, "
    f"COUNT(*) FILTER (WHERE t >= {BAND_THR}) AS n_at_or_above FROM "
    f"(SELECT order_id, SUM(total) AS t FROM transactions WHERE order_id IS NOT NULL GROUP BY order_id)"))
def q_order_value_bands(spark, sf_dir):
    return ex.order_value_bands(tx(spark, sf_dir), BAND_THR)


@register("distinct_countries", with_tx("SELECT DISTINCT country FROM transactions"))
def q_distinct_countries(spark, sf_dir):
    return ex.distinct_values(tx(spark, sf_dir), "country")


@register("distinct_customers", with_tx("SELECT DISTINCT customer_id FROM transactions"))
def q_distinct_customers(spark, sf_dir):
    return ex.distinct_values(tx(spark, sf_dir), "customer_id")


_CUST_TOTALS = ("SELECT customer_id, CAST(SUM(total) AS DOUBLE) AS total FROM transactions "
                "WHERE customer_id IS NOT NULL GROUP BY customer_id")


@register("spend_quantile", with_tx(
    f"SELECT ROUND(quantile_cont(total, {TOP_Q}), 6) AS quantile FROM ({_CUST_TOTALS})"))
def q_spend_quantile(spark, sf_dir):
    q = ex.quantile(ex.spend_by_customer(tx(spark, sf_dir)), "total", TOP_Q)
    return q.select(F.round("quantile", 6).alias("quantile"))


@register("top_spenders", with_tx(
    f"SELECT customer_id, total FROM ({_CUST_TOTALS}) "
    f"WHERE total > (SELECT quantile_cont(total, {TOP_Q}) FROM ({_CUST_TOTALS}))"))
def q_top_spenders(spark, sf_dir):
    return ex.top_spenders(tx(spark, sf_dir), TOP_Q)


_DAYS = ("SELECT order_id, COUNT(DISTINCT strftime(order_date, '%Y-%m-%d')) AS n_days "
         "FROM transactions WHERE order_id IS NOT NULL GROUP BY order_id")


@register("orders_multi_day", with_tx(f"SELECT * FROM ({_DAYS}) WHERE n_days > 1", date_col="l_shipdate"))
def q_orders_multi_day(spark, sf_dir):
    return ex.orders_multi_day(tx(spark, sf_dir, "l_shipdate"))


@register("orders_single_day", with_tx(f"SELECT order_id FROM ({_DAYS}) WHERE n_days = 1",
                                       date_col="l_shipdate"))
def q_orders_single_day(spark, sf_dir):
    return ex.orders_single_day(tx(spark, sf_dir, "l_shipdate"))


_TERMS = ("SELECT term, COUNT(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(description), '[a-z]+')) "
          "AS term FROM transactions {where}) WHERE term NOT IN ({stop}) GROUP BY term")


@register("term_counts_all", with_tx(_TERMS.format(where="", stop=_STOP)))
def q_term_counts_all(spark, sf_dir):
    return ex.term_counts(tx(spark, sf_dir))


@register("term_counts_month", with_tx(_TERMS.format(
    where=f"WHERE strftime(order_date, '%Y-%m') = '{PREV_MONTH}'", stop=_STOP)))
def q_term_counts_month(spark, sf_dir):
    return ex.term_counts(tx(spark, sf_dir), PREV_MONTH)


_AVG_SPEND = ("SELECT customer_id, CAST(SUM(total) AS DOUBLE) / COUNT(DISTINCT order_id) AS average_spending "
              "FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id")


@register("avg_spend_rows", with_tx(
    f"SELECT t.*, a.average_spending FROM transactions t LEFT JOIN ({_AVG_SPEND}) a "
    f"ON t.customer_id = a.customer_id"))
def q_avg_spend_rows(spark, sf_dir):
    return ex.join_avg_spend(tx(spark, sf_dir))


@register("dataset_project", with_tx(
    f"SELECT t.customer_id, strftime(order_date, '%Y-%m-%d') AS year_month_day, order_id, product_id, "
    f"description, quantity, price, country, total, a.average_spending FROM transactions t "
    f"LEFT JOIN ({_AVG_SPEND}) a ON t.customer_id = a.customer_id"))
def q_dataset_project(spark, sf_dir):
    return ex.prepared_dataset(tx(spark, sf_dir))


@register("order_id_anomalies", with_tx(
    "SELECT COUNT(*) FILTER (WHERE NOT regexp_full_match(order_id, '[0-9]+') "
    "AND substring(order_id, 1, 1) <> 'C') AS n_anomalies FROM transactions"))
def q_order_id_anomalies(spark, sf_dir):
    return an.order_id_anomalies(tx(spark, sf_dir))


@register("product_anomalies", with_tx(f"SELECT DISTINCT product_id FROM transactions WHERE {_ANOM}"))
def q_product_anomalies(spark, sf_dir):
    return an.product_anomalies(tx(spark, sf_dir))


@register("anomaly_customers", with_tx(
    f"SELECT DISTINCT customer_id FROM transactions WHERE customer_id IS NOT NULL AND product_id IN "
    f"(SELECT product_id FROM transactions WHERE {_ANOM})"))
def q_anomaly_customers(spark, sf_dir):
    df = tx(spark, sf_dir)
    return an.customers_with(df, an.product_anomalies(df))


@register("outlier_customers", with_tx(
    f"SELECT customer_id, 1 AS outlier FROM (SELECT customer_id, COUNT(*) AS n, MIN(product_id) AS p "
    f"FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id) "
    f"WHERE n < {MAX_ROWS} AND NOT regexp_full_match(substring(p, 1, 5), '[0-9]+')"))
def q_outlier_customers(spark, sf_dir):
    return an.outlier_customers(tx(spark, sf_dir), MAX_ROWS)


@register("outlier_flag", with_tx(
    f"SELECT outlier, COUNT(*) AS n_rows, COUNT(DISTINCT customer_id) AS n_customers FROM ("
    f"SELECT t.customer_id, COALESCE(o.outlier, 0) AS outlier FROM transactions t LEFT JOIN "
    f"(SELECT customer_id, 1 AS outlier FROM (SELECT customer_id, COUNT(*) AS n, MIN(product_id) AS p "
    f"FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id) "
    f"WHERE n < {MAX_ROWS} AND NOT regexp_full_match(substring(p, 1, 5), '[0-9]+')) o "
    f"ON t.customer_id = o.customer_id) GROUP BY outlier"))
def q_outlier_flag(spark, sf_dir):
    rows = an.flag_outliers(tx(spark, sf_dir), MAX_ROWS)
    return rows.groupBy("outlier").agg(F.count(F.lit(1)).alias("n_rows"),
                                       F.count_distinct("customer_id").alias("n_customers"))


@register("small_history_suspects", with_tx(
    f"SELECT customer_id FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id "
    f"HAVING COUNT(*) <= {SUSPECT_N} AND bool_or(COALESCE({_ANOM}, false))"))
def q_small_history_suspects(spark, sf_dir):
    return an.small_history_suspects(tx(spark, sf_dir), SUSPECT_N)


@register("product_normalized", with_tx(
    f"SELECT order_id, line_seq, product_id AS raw_product_id, {_NORM} AS product_id FROM transactions"))
def q_product_normalized(spark, sf_dir):
    return tx(spark, sf_dir).select("order_id", "line_seq", F.col("product_id").alias("raw_product_id"),
                                    normalize_product_id("product_id").alias("product_id"))


@register("product_prefix", with_tx(
    f"SELECT substring({_NORM}, 1, 3) AS product_prefix, COUNT(*) AS n_rows FROM transactions GROUP BY 1"))
def q_product_prefix(spark, sf_dir):
    return (tx(spark, sf_dir).groupBy(product_prefix("product_id").alias("product_prefix"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


_FIRST_SEEN = ("SELECT country, CAST(ROW_NUMBER() OVER (ORDER BY f, country) - 1 AS INTEGER) AS country_code "
               "FROM (SELECT country, MIN((order_date, order_id, line_seq)) AS f FROM transactions "
               "WHERE country IS NOT NULL GROUP BY country)")


@register("country_code", with_tx(
    f"SELECT c.country, c.country_code, COUNT(*) AS n_rows FROM transactions t "
    f"JOIN ({_FIRST_SEEN}) c ON t.country = c.country GROUP BY 1, 2"))
def q_country_code(spark, sf_dir):
    rows = lk.country_code(tx(spark, sf_dir))
    return rows.groupBy("country", "country_code").agg(F.count(F.lit(1)).alias("n_rows"))


_EU_CASE = "CASE " + " ".join(f"WHEN country = '{k}' THEN {v}" for k, v in EU_FLAG.items()) + " END"


@register("eu_flag", with_tx(
    f"SELECT country, CAST({_EU_CASE} AS INTEGER) AS eu, COUNT(*) AS n_rows FROM transactions GROUP BY 1, 2"))
def q_eu_flag(spark, sf_dir):
    return lk.eu_flag(tx(spark, sf_dir)).groupBy("country", "eu").agg(F.count(F.lit(1)).alias("n_rows"))


@register("only_anomalous_customers", with_tx(
    f"SELECT customer_id FROM transactions WHERE customer_id IS NOT NULL GROUP BY customer_id "
    f"HAVING bool_and(COALESCE({_ANOM}, false))"))
def q_only_anomalous_customers(spark, sf_dir):
    return an.only_codes_customers(tx(spark, sf_dir))


@register("customer_sessions", with_tx(
    "SELECT customer_id, COUNT(*) FILTER (WHERE prev_ts IS NULL OR ts - prev_ts > 300) AS n_sessions, "
    "CAST(COUNT(*) FILTER (WHERE prev_ts IS NULL OR ts - prev_ts > 300) > 1 AS INTEGER) AS returned "
    "FROM (SELECT customer_id, epoch(order_date) AS ts, LAG(epoch(order_date)) OVER "
    "(PARTITION BY customer_id ORDER BY order_date, order_id, line_seq) AS prev_ts FROM transactions "
    "WHERE customer_id IS NOT NULL) GROUP BY customer_id", date_col="l_shipdate"))
def q_customer_sessions(spark, sf_dir):
    return ex.customer_sessions(tx(spark, sf_dir, "l_shipdate"))


@register("repurchase_rate", with_tx(
    "SELECT strftime(CAST(p.ym || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') AS year_month, "
    "COUNT(*) AS n_prev_active, COUNT(c.customer_id) AS n_returning, "
    "CAST(COUNT(c.customer_id) AS DOUBLE) / COUNT(*) AS repurchase_rate "
    "FROM a p LEFT JOIN a c ON p.customer_id = c.customer_id "
    "AND c.ym = strftime(CAST(p.ym || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') "
    "WHERE strftime(CAST(p.ym || '-01' AS DATE) + INTERVAL 1 MONTH, '%Y-%m') <= (SELECT max(ym) FROM a) GROUP BY 1",
    "a AS (SELECT DISTINCT customer_id, strftime(order_date, '%Y-%m') AS ym FROM transactions "
    "WHERE customer_id IS NOT NULL)"))
def q_repurchase_rate(spark, sf_dir):
    return ex.repurchase_rate(tx(spark, sf_dir))


@register("postage_by_country", with_tx(
    "SELECT country, COUNT(*) AS n_post, CAST(RANK() OVER (ORDER BY COUNT(*) DESC) AS INTEGER) AS rank "
    "FROM transactions WHERE product_id = 'POST' GROUP BY country"))
def q_postage_by_country(spark, sf_dir):
    return ex.postage_by_country(tx(spark, sf_dir))
