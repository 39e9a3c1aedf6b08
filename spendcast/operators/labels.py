"""Month labels and the rule baseline.

Each operator is one scan and one aggregate by ``customer_id`` (partial
aggregation on the map side, so a customer with many rows costs one row per
task in the shuffle); the spine and the month totals come out of the same
aggregate instead of a self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.functions.periods import add_months, month_start, prev_month
from spendcast.functions.stats import clip01

TOTAL_THRES = 300


def customer_spine(df: DataFrame, m: str) -> DataFrame:
    """Distinct customers with any row before month ``m`` (null ids dropped)."""
    return (df.where((F.col("order_date") < month_start(m)) & F.col("customer_id").isNotNull())
            .select("customer_id").distinct()
            .withColumn("year_month", F.lit(m)))


def month_label(df: DataFrame, m: str, thr=TOTAL_THRES, sort: bool = True) -> DataFrame:
    """Spine of month ``m`` with its spend in ``m`` (0 when none) and the
    label ``spend > thr``.  Columns: customer_id, year_month, total, label."""
    start, end = month_start(m), month_start(add_months(m, 1))
    in_m = F.col("order_date") >= start
    per_cust = (df.where((F.col("order_date") < end) & F.col("customer_id").isNotNull())
                .groupBy("customer_id")
                .agg(F.bool_or(~in_m).alias("seen"),
                     F.sum(F.when(in_m, F.col("total"))).alias("t")))
    total = F.coalesce(F.col("t"), F.lit(0))
    out = per_cust.where("seen").select(
        "customer_id", F.lit(m).alias("year_month"),
        total.cast("double").alias("total"),
        (total > F.lit(thr)).cast("int").alias("label"))
    return out.orderBy("customer_id") if sort else out


def month_labels(df: DataFrame, months: list[str], thr=TOTAL_THRES) -> DataFrame:
    """Labels of several months from one scan and one aggregate: per
    customer, whether they were seen before each month and their spend in
    it; then one output row per (customer, month) of that month's spine."""
    months = sorted(set(months))
    end = month_start(add_months(months[-1], 1))
    aggs = []
    for i, m in enumerate(months):
        start, stop = month_start(m), month_start(add_months(m, 1))
        in_m = (F.col("order_date") >= start) & (F.col("order_date") < stop)
        aggs += [F.bool_or(F.col("order_date") < start).alias(f"_seen{i}"),
                 F.sum(F.when(in_m, F.col("total"))).alias(f"_t{i}")]
    per_cust = (df.where((F.col("order_date") < end) & F.col("customer_id").isNotNull())
                .groupBy("customer_id").agg(*aggs))
    per_month = F.explode(F.array(*[
        F.struct(F.lit(m).alias("year_month"), F.col(f"_seen{i}").alias("seen"),
                 F.coalesce(F.col(f"_t{i}"), F.lit(0)).alias("t"))
        for i, m in enumerate(months)])).alias("_m")
    rows = per_cust.select("customer_id", per_month).where("_m.seen")
    return rows.select("customer_id", F.col("_m.year_month").alias("year_month"),
                       F.col("_m.t").cast("double").alias("total"),
                       (F.col("_m.t") > F.lit(thr)).cast("int").alias("label"))


def baseline_prob(df: DataFrame, m: str, thr=TOTAL_THRES, include_new: bool = False) -> DataFrame:
    """Rule baseline: previous month's spend / ``thr`` clipped to [0, 1], for
    every customer of month ``m``'s spine.

    As in the original rule, a customer first seen in the previous month is
    not in that month's label spine and scores 0; ``include_new=True`` uses
    their spend instead.
    """
    pm = prev_month(m)
    start, prev_start = month_start(m), month_start(pm)
    in_prev = F.col("order_date") >= prev_start
    per_cust = (df.where((F.col("order_date") < start) & F.col("customer_id").isNotNull())
                .groupBy("customer_id")
                .agg(F.bool_or(~in_prev).alias("seen_before_prev"),
                     F.sum(F.when(in_prev, F.col("total"))).alias("prev_total")))
    prev_total = F.coalesce(F.col("prev_total"), F.lit(0))
    if not include_new:
        prev_total = F.when(F.col("seen_before_prev"), prev_total).otherwise(F.lit(0))
    prob = clip01(prev_total.cast("double") / F.lit(float(thr)))
    return per_cust.select("customer_id", prob.alias("probability"))
