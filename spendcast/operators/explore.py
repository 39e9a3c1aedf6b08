"""Exploratory aggregates: spend by customer/month/order, order value bands,
top spenders, multi-day orders, term counts, the prepared dataset.

All group-bys use map-side partial aggregation, so a key holding a large
share of the rows still sends one partial row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendcast.functions.periods import day_key, in_month, month_key
from spendcast.functions.stats import exact_mean
from spendcast.operators.scan import prefix_scan

def _nn():
    return F.col("customer_id").isNotNull()


def spend_by_customer(df: DataFrame) -> DataFrame:
    return (df.where(_nn()).groupBy("customer_id")
            .agg(F.sum("total").cast("double").alias("total")))


def spend_by_month(df: DataFrame) -> DataFrame:
    return (df.where("order_date is not null").groupBy(month_key().alias("year_month"))
            .agg(F.sum("total").cast("double").alias("total")))


def mean_by_month(df: DataFrame) -> DataFrame:
    return (df.where("order_date is not null").groupBy(month_key().alias("year_month"))
            .agg(exact_mean("total").alias("mean_total")))


def customer_mean_in_month(df: DataFrame, m: str) -> DataFrame:
    return (in_month(df, m).where(_nn()).groupBy("customer_id")
            .agg(exact_mean("total").alias("mean_total")))


def spend_by_customer_month(df: DataFrame) -> DataFrame:
    return (df.where(_nn() & F.col("order_date").isNotNull()).groupBy("customer_id", month_key().alias("year_month"))
            .agg(F.sum("total").cast("double").alias("total_sum")))


def order_totals(df: DataFrame) -> DataFrame:
    return (df.where(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.sum("total").alias("order_total")))


def spend_by_customer_order(df: DataFrame) -> DataFrame:
    return (df.where(_nn() & F.col("order_id").isNotNull()).groupBy("customer_id", "order_id")
            .agg(F.sum("total").cast("double").alias("order_total")))


def mean_of_order_means(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Per customer, the mean over orders of each order's mean line total."""
    per_order = (df.where(_nn() & F.col("order_id").isNotNull())
                 .groupBy("customer_id", "order_id")
                 .agg(exact_mean("total").alias("m")))
    out = F.avg("m")
    if digits is not None:
        out = F.round(out, digits)
    return per_order.groupBy("customer_id").agg(out.alias("mean_order_mean"))


def average_spending(df: DataFrame) -> DataFrame:
    """Per customer, the mean order value: spend / number of orders."""
    return (df.where(_nn()).groupBy("customer_id")
            .agg((F.sum("total").cast("double")
                  / F.nullif(F.count_distinct("order_id"), F.lit(0)).cast("double"))
                 .alias("average_spending")))


def join_avg_spend(df: DataFrame) -> DataFrame:
    """Attach each customer's mean order value to their rows.  Shuffle join
    on customer_id; AQE's skew-join split covers a customer with a large
    share of the rows."""
    return df.join(average_spending(df), "customer_id", "left")


def order_value_bands(df: DataFrame, thr=300) -> DataFrame:
    """Number of orders with value <= 0, < thr, >= thr (one row)."""
    t = F.col("order_total")
    return order_totals(df).agg(
        F.count_if(t <= 0).alias("n_nonpositive"),
        F.count_if(t < F.lit(thr)).alias("n_below"),
        F.count_if(t >= F.lit(thr)).alias("n_at_or_above"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def quantile(df: DataFrame, col: str, q: float, name: str = "quantile") -> DataFrame:
    """Exact quantile with linear interpolation (one row).

    No single task holds the values: they collapse to counts per distinct
    value, the skew-safe scan sums the counts, and only the one or two values
    around position ``q * (n - 1)`` are kept.
    """
    vals = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"))
    n = vals.agg(F.count(F.lit(1))).scalar()  # scalar subquery, run once
    pos = F.lit(q) * (n - 1)
    counts = vals.groupBy("v").agg(F.count(F.lit(1)).alias("k"))
    scanned = prefix_scan(counts, [], [F.col("v")], sums={"upto": "k"})
    holds = lambda i: (F.col("upto") - F.col("k") <= i) & (i < F.col("upto"))
    near = scanned.where(holds(F.floor(pos)) | holds(F.ceil(pos))).select("v", pos.alias("pos"))
    lo, hi = F.min("v"), F.max("v")
    frac = F.first("pos") - F.floor(F.first("pos"))
    return near.agg((lo + (hi - lo) * frac).alias(name))


def top_spenders(df: DataFrame, q: float = 0.999) -> DataFrame:
    """Customers whose total spend is strictly above the ``q`` quantile."""
    totals = spend_by_customer(df)
    cut = quantile(totals, "total", q, name="cut").scalar()  # scalar subquery
    return totals.where(F.col("total") > cut).select("customer_id", "total")


def order_day_counts(df: DataFrame) -> DataFrame:
    return (df.where(F.col("order_id").isNotNull()).groupBy("order_id")
            .agg(F.count_distinct(day_key()).alias("n_days")))


def orders_multi_day(df: DataFrame) -> DataFrame:
    return order_day_counts(df).where(F.col("n_days") > 1)


def orders_single_day(df: DataFrame) -> DataFrame:
    return order_day_counts(df).where(F.col("n_days") == 1).select("order_id")


# English function words dropped from term counts (our own
# list; the original relied on a plotting library's built-in set).
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before "
    "being below between both but by can could did do does doing down during each few for "
    "from further had has have having he her here hers herself him himself his how i if in "
    "into is it its itself just me more most my myself no nor not now of off on once only or "
    "other our ours ourselves out over own same she should so some such than that the their "
    "theirs them themselves then there these they this those through to too under until up "
    "very was we were what when where which while who whom why will with would you your "
    "yours yourself yourselves"
).split()


def terms(col: Column | str = "description") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.explode(F.regexp_extract_all(F.lower(c), F.lit("[a-z]+"), 0))


def term_counts(df: DataFrame, m: str | None = None,
                stop: Iterable[str] = STOP_WORDS) -> DataFrame:
    """Word frequencies of ``description`` (one month or all rows)."""
    if m is not None:
        df = in_month(df, m)
    words = df.select(terms().alias("term"))
    return (words.where(~F.col("term").isin(list(stop)))
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


DATASET_COLUMNS = ("customer_id", "year_month_day", "order_id", "product_id", "description",
                   "quantity", "price", "country", "total")


def dataset_project(df: DataFrame) -> DataFrame:
    """Rows with the day key in place of the timestamp, columns reordered."""
    return df.withColumn("year_month_day", day_key()).select(*DATASET_COLUMNS)


def prepared_dataset(df: DataFrame) -> DataFrame:
    """Day-keyed rows with each customer's mean order value, sorted by day."""
    return (dataset_project(df).join(average_spending(df), "customer_id", "left")
            .orderBy("year_month_day", "customer_id"))


def sort_rows(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return df.orderBy(*keys)


def for_customer(df: DataFrame, customer) -> DataFrame:
    """Rows of one customer: an id, or a DataFrame of ids (semi join)."""
    if isinstance(customer, DataFrame):
        return df.join(customer.select("customer_id"), "customer_id", "left_semi")
    return df.where(F.col("customer_id") == F.lit(customer))


def busiest_customer(df: DataFrame) -> DataFrame:
    """The customer with the most rows (smallest id on ties); one row."""
    return (df.where(_nn()).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "customer_id").limit(1).select("customer_id"))


# --- ideas stated in the exploration notes (sessions, repurchase, postage) --

def customer_sessions(df: DataFrame, gap_seconds: int = 300, method: str = "chunked") -> DataFrame:
    """Per customer, the number of shopping sessions (rows less than
    ``gap_seconds`` apart belong to one session) and whether they returned
    after their first session.  The previous-row timestamp comes from the
    skew-safe scan."""
    from spendcast.functions.periods import epoch_seconds
    from spendcast.operators.scan import prefix_scan
    from spendcast.sources.transactions import order_cols
    rows = df.where(_nn()).select("customer_id", "order_date", "order_id", "line_seq",
                                  epoch_seconds().alias("ts"))
    rows = prefix_scan(rows, ["customer_id"], order_cols(), lags={"prev_ts": "ts"}, method=method)
    new = F.col("prev_ts").isNull() | (F.col("ts") - F.col("prev_ts") > gap_seconds)
    return (rows.groupBy("customer_id").agg(F.count_if(new).alias("n_sessions"))
            .withColumn("returned", (F.col("n_sessions") > 1).cast("int")))


def repurchase_rate(df: DataFrame) -> DataFrame:
    """Per month, the customers active in the previous month, how many of
    them are active again, and the share.  Equi-join of distinct
    (customer, month) pairs on the shifted month: no hot key."""
    active = df.where(_nn()).select("customer_id", month_key().alias("year_month")).distinct()
    prev = active.select("customer_id", F.date_format(
        F.add_months(F.to_date("year_month", "yyyy-MM"), 1), "yyyy-MM").alias("year_month"),
        F.lit(1).alias("was_active"))
    last = active.agg(F.max("year_month").alias("m")).scalar()  # no month beyond the data
    joined = prev.where(F.col("year_month") <= last).join(active.withColumn("is_active", F.lit(1)), ["customer_id", "year_month"], "left")
    return (joined.groupBy("year_month")
            .agg(F.count(F.lit(1)).alias("n_prev_active"),
                 F.count("is_active").alias("n_returning"))
            .withColumn("repurchase_rate",
                        F.col("n_returning").cast("double") / F.col("n_prev_active").cast("double")))


def postage_by_country(df: DataFrame, code: str = "POST") -> DataFrame:
    """Postage lines per country, ranked (rank 1 = most).  The ranking window
    sees one row per country."""
    from pyspark.sql import Window
    counts = (df.where(F.col("product_id") == code).groupBy("country")
              .agg(F.count(F.lit(1)).alias("n_post")))
    return counts.withColumn("rank", F.rank().over(Window.orderBy(F.desc("n_post"))))
