"""Queries: scan, month keys, cuts, labels and the rule baseline."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendcast.functions.periods import (day_key, epoch_seconds, history_before, in_month,
                                         month_key)
from spendcast.operators.labels import baseline_prob, customer_spine, month_label, month_labels
from spendcast.plans.base import MONTH, PREV_MONTH, THR, register, tx, with_tx
from spendcast.sources import sinks
from spendcast.sources.csv_records import BAD, bad_records
from spendcast.sources.transactions import read_transactions

_LABEL_SQL = """
SELECT s.customer_id, s.year_month, CAST(COALESCE(t.total, 0) AS DOUBLE) AS total,
       CAST(COALESCE(t.total, 0) > {thr} AS INTEGER) AS label
FROM (SELECT DISTINCT customer_id, '{m}' AS year_month FROM transactions
      WHERE order_date < TIMESTAMP '{m}-01' AND customer_id IS NOT NULL) s
LEFT JOIN (SELECT customer_id, SUM(total) AS total FROM transactions
           WHERE strftime(order_date, '%Y-%m') = '{m}' GROUP BY customer_id) t
  ON s.customer_id = t.customer_id
"""


@register("tx_scan", with_tx("SELECT * FROM transactions"))
def q_tx_scan(spark, sf_dir):
    return tx(spark, sf_dir)


@register("month_key", with_tx(
    "SELECT order_id, line_seq, strftime(order_date, '%Y-%m') AS year_month FROM transactions"))
def q_month_key(spark, sf_dir):
    return tx(spark, sf_dir).select("order_id", "line_seq", month_key().alias("year_month"))


@register("day_key", with_tx(
    "SELECT order_id, line_seq, strftime(order_date, '%Y-%m-%d') AS year_month_day FROM transactions"))
def q_day_key(spark, sf_dir):
    return tx(spark, sf_dir).select("order_id", "line_seq", day_key().alias("year_month_day"))


@register("epoch_seconds", with_tx(
    "SELECT order_id, line_seq, CAST(epoch(order_date) AS DOUBLE) AS order_ts FROM transactions"))
def q_epoch_seconds(spark, sf_dir):
    return tx(spark, sf_dir).select("order_id", "line_seq", epoch_seconds().alias("order_ts"))


@register("history_cut", with_tx(
    f"SELECT order_id, line_seq, customer_id, total FROM transactions "
    f"WHERE order_date < TIMESTAMP '{PREV_MONTH}-01'"))
def q_history_cut(spark, sf_dir):
    return history_before(tx(spark, sf_dir), PREV_MONTH).select(
        "order_id", "line_seq", "customer_id", "total")


@register("month_slice", with_tx(
    f"SELECT order_id, line_seq, customer_id, total FROM transactions "
    f"WHERE strftime(order_date, '%Y-%m') = '{PREV_MONTH}'"))
def q_month_slice(spark, sf_dir):
    return in_month(tx(spark, sf_dir), PREV_MONTH).select(
        "order_id", "line_seq", "customer_id", "total")


@register("customer_spine", with_tx(
    f"SELECT DISTINCT customer_id, '{MONTH}' AS year_month FROM transactions "
    f"WHERE order_date < TIMESTAMP '{MONTH}-01' AND customer_id IS NOT NULL"))
def q_customer_spine(spark, sf_dir):
    return customer_spine(tx(spark, sf_dir), MONTH)


@register("month_label", with_tx(_LABEL_SQL.format(m=MONTH, thr=THR)))
def q_month_label(spark, sf_dir):
    return month_label(tx(spark, sf_dir), MONTH, THR)


@register("label_prev_month", with_tx(_LABEL_SQL.format(m=PREV_MONTH, thr=THR)))
def q_label_prev_month(spark, sf_dir):
    return month_label(tx(spark, sf_dir), PREV_MONTH, THR)


@register("baseline_prob", with_tx(f"""
SELECT cur.customer_id,
       LEAST(GREATEST(CAST(COALESCE(prev.total, 0) AS DOUBLE) / {float(THR)}, 0.0), 1.0) AS probability
FROM ({_LABEL_SQL.format(m=MONTH, thr=THR)}) cur
LEFT JOIN ({_LABEL_SQL.format(m=PREV_MONTH, thr=THR)}) prev ON cur.customer_id = prev.customer_id
"""))
def q_baseline_prob(spark, sf_dir):
    return baseline_prob(tx(spark, sf_dir), MONTH, THR)


@register("customer_lookup", with_tx(
    "SELECT * FROM transactions WHERE customer_id = "
    "(SELECT customer_id FROM transactions GROUP BY customer_id ORDER BY COUNT(*) DESC, customer_id LIMIT 1)"))
def q_customer_lookup(spark, sf_dir):
    from spendcast.operators.explore import for_customer, busiest_customer
    df = tx(spark, sf_dir)
    return for_customer(df, busiest_customer(df))


_BASE_COLS = ("order_id", "product_id", "description", "quantity", "order_date", "price",
              "customer_id", "country", "total")


@register("csv_scan", with_tx(f"SELECT {', '.join(_BASE_COLS)} FROM transactions"))
def q_csv_scan(spark, sf_dir):
    """Order lines written as a headered CSV file (the original input format)
    and read back with the fixed schema."""
    path = sinks.scratch_path(spark, "order-lines")
    sinks.write_dataset(tx(spark, sf_dir).select(*_BASE_COLS), path, "csv",
                        options={"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"})
    return read_transactions(spark, path, "csv").select(*_BASE_COLS)


@register("month_labels", with_tx(
    _LABEL_SQL.format(m=PREV_MONTH, thr=THR) + " UNION ALL " + _LABEL_SQL.format(m=MONTH, thr=THR)))
def q_month_labels(spark, sf_dir):
    return month_labels(tx(spark, sf_dir), [PREV_MONTH, MONTH], THR)


_KNOTTY = "description || ' \"' || product_id || '\", 5\" wide;' || chr(10) || '\"\"' || chr(13) || chr(10) || country"


@register("csv_quoted", with_tx(f"SELECT order_id, line_seq, {_KNOTTY} AS description, total FROM transactions"))
def q_csv_quoted(spark, sf_dir):
    """Texts with quotes, separators and line feeds through CSV and back, by split."""
    rows = tx(spark, sf_dir).select("order_id", "line_seq", F.expr(_KNOTTY.replace("chr(", "char(")).alias("description"), "total")
    path = sinks.scratch_path(spark, "quoted-lines")
    sinks.write_dataset(rows, path, "csv")
    return sinks.read_dataset(spark, path, rows.schema, "csv")


def _dirty_lines(spark, sf_dir):
    """Order lines as CSV text, some of them as other tools write them (dates without a
    time, whole numbers with a fraction), some broken: by line number in the order."""
    at = lambda k, bad, good: F.when(F.col("line_seq") == k, bad).otherwise(good)
    text = lambda c: F.col(c).cast("string")
    stamp = F.date_format("order_date", "yyyy-MM-dd HH:mm:ss")
    fields = [text("order_id"), text("product_id"), F.concat(F.lit('"'), F.col("description"), F.lit('"')),
              at(4, F.concat(F.lit("x"), text("quantity")), text("quantity")),
              at(2, F.date_format("order_date", "yyyy-MM-dd"), at(6, F.lit("2001-13-45"), stamp)),
              at(6, F.lit("n/a"), text("price")), at(3, F.concat(text("customer_id"), F.lit(".0")), text("customer_id")), text("country"), text("total")]
    line = F.concat_ws(",", *fields)
    return tx(spark, sf_dir).select(at(5, F.regexp_replace(line, ",[^,]*$", ""), line).alias("value"))


def _read_dirty(spark, sf_dir):
    path = sinks.scratch_path(spark, "dirty-lines")
    sinks.write_text(_dirty_lines(spark, sf_dir), path, header=",".join(_BASE_COLS))
    return read_transactions(spark, path, bad="mark")


@register("csv_dirty_rows", with_tx("""
SELECT order_id, CASE WHEN line_seq <> 4 THEN quantity END AS quantity,
       CASE line_seq WHEN 2 THEN CAST(CAST(order_date AS DATE) AS TIMESTAMP) WHEN 6 THEN NULL ELSE order_date END AS order_date,
       CASE WHEN line_seq <> 6 THEN price END AS price, customer_id, country, CASE WHEN line_seq <> 5 THEN total END AS total,
       CASE line_seq WHEN 4 THEN 'quantity' WHEN 5 THEN 'fields' WHEN 6 THEN 'order_date,price' END AS bad
FROM transactions"""))
def q_csv_dirty_rows(spark, sf_dir):
    return _read_dirty(spark, sf_dir).select("order_id", "quantity", "order_date", "price", "customer_id", "country", "total",
                                             F.array_join(BAD, ",").alias("bad"))


@register("csv_bad_records", with_tx("""
SELECT NULL AS reason, COUNT(*) AS records FROM transactions UNION ALL
SELECT reason, COUNT(*) FROM (SELECT unnest(CASE line_seq WHEN 4 THEN ['quantity'] WHEN 5 THEN ['fields']
                                            WHEN 6 THEN ['order_date', 'price'] END) AS reason FROM transactions) GROUP BY reason"""))
def q_csv_bad_records(spark, sf_dir):
    return bad_records(_read_dirty(spark, sf_dir))
