"""Point-in-time feature matrix (124 columns per customer) and the
training / scoring sets.

Plan shape:

* ``enrich_rows`` derives row-level columns once for the latest cut (product family,
  postage, EU flag, epoch seconds).  One range shuffle by time gives the running sums per
  product family and per order (``operators.timeline``), and is written.  Then the rows
  are dealt by customer, once, ``DEALT_ROWS`` to a task: 4 running sums, 4 differences and the first rows of each
  order and product family are windows there, and so are the statistics, their merge along
  the months, the cuts and the labels that follow.  Money is a whole number of hundredths
  from the first shuffle to the statistics, if all sums fit 64 bits (checked on all rows).
  Customers with more than ``HOT_ROWS`` rows take the range-partitioned scan instead.  Running values only look backwards in the
  row order, so an earlier cut reads the same values.
* ``feature_matrices`` reads the enriched rows once into partial statistics per
  customer and month, merges these along the months, and takes the state before
  each cut (``operators.partials``).  Outlier flags come from the state before the cut
  only, so no future row leaks into a feature: a country's code is its rank by first
  appearance, which later rows do not change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendcast.functions.codes import product_anomalous, product_prefix
from spendcast.functions.lookups import eu_flag
from spendcast.functions.periods import add_months, epoch_seconds, history_before, month_start, prev_month
from spendcast.functions.stats import SEVEN_STATS
from spendcast.operators.labels import TOTAL_THRES, month_label, month_labels
from spendcast.operators.lookups import first_seen_code
from spendcast.operators import partials as pt
from spendcast.operators import timeline as tl
from spendcast.operators.prepare import impute_median
from spendcast.operators.running import scan_customer
from spendcast.operators.scan import materialize, prefix_scan
from spendcast.operators.stats import post_amount
from spendcast.sources.transactions import ORDER_KEY, order_cols

CUST_SUMS = {
    "cumsum_total_by_cust_id": "total",
    "cumsum_quantity_by_cust_id": "quantity",
    "cumsum_price_by_cust_id": "price",
    "cumsum_post_by_cust_id": "post",
}
PROD_SUMS = {
    "cumsum_total_by_prod_id": "total",
    "cumsum_quantity_by_prod_id": "quantity",
    "cumsum_price_by_prod_id": "price",
}
ORDER_SUMS = {
    "cumsum_total_by_order_id": "total",
    "cumsum_quantity_by_order_id": "quantity",
    "cumsum_price_by_order_id": "price",
}
DIFFS = {
    "order_ts_diff": "order_ts",
    "quantity_diff": "quantity",
    "price_diff": "price",
    "total_diff": "total",
}

# Names and order of the feature columns, an output contract.
# (column, statistics) in output order; names are "{column}-{statistic}".
FEATURE_SPEC = (
    ("quantity", SEVEN_STATS), ("price", SEVEN_STATS), ("total", SEVEN_STATS),
    ("cumsum_total_by_cust_id", SEVEN_STATS), ("cumsum_quantity_by_cust_id", SEVEN_STATS),
    ("cumsum_price_by_cust_id", SEVEN_STATS),
    ("cumsum_post_by_cust_id", ("min", "max", "sum", "std")),
    ("cumsum_total_by_prod_id", SEVEN_STATS), ("cumsum_quantity_by_prod_id", SEVEN_STATS),
    ("cumsum_price_by_prod_id", SEVEN_STATS),
    ("cumsum_total_by_order_id", SEVEN_STATS), ("cumsum_quantity_by_order_id", SEVEN_STATS),
    ("cumsum_price_by_order_id", SEVEN_STATS),
    ("order_id", ("nunique",)), ("product_id", ("nunique",)),
    ("order_ts", ("first", "last")),
    ("order_ts_diff", SEVEN_STATS), ("quantity_diff", SEVEN_STATS),
    ("price_diff", SEVEN_STATS), ("total_diff", SEVEN_STATS),
    ("country_code", ("last",)), ("eu", ("last",)), ("post", ("sum",)), ("outlier", ("last",)),
)
FEATURE_NAMES = tuple(f"{c}-{s}" for c, stats in FEATURE_SPEC for s in stats)


_CODE_BYTES = 7  # of a product code, as a number that sorts like the code; five digits fit


def _code_key() -> "F.Column":
    start = F.substring(F.col("product_id").cast("binary"), 1, _CODE_BYTES)
    return F.conv(F.rpad(F.hex(start), 2 * _CODE_BYTES, "0"), 16, 10).cast("long")


def _code_start(key: str) -> "F.Column":
    """The start of the code that ``_code_key`` made a number of."""
    return F.rtrim(F.unhex(F.lpad(F.hex(F.col(key)), 2 * _CODE_BYTES, "0")).cast("string"), F.lit("\0"))


#: Rows of one customer beyond which their scan is cut into ranges.
HOT_ROWS = 1_000_000
#: Rows dealt by customer to one task: they are sorted three times there, some 400 bytes each.
DEALT_ROWS = 250_000
#: Groups of customers counted to find those with many rows.
_GROUPS = 1 << 16
_BEGUN = {"order_id": "order_begun", "product_id": "product_begun"}


def _begun(rows: DataFrame, position: str | list, order_key: str) -> DataFrame:
    """1 on the first row of each of a customer's orders and product families, else 0."""
    first = lambda c: F.when(F.col(c).isNotNull() & (F.row_number().over(
        Window.partitionBy("customer_id", c).orderBy(*position)) == 1), 1).otherwise(0)
    return rows.withColumns({"order_begun": first(order_key), "product_begun": first("product_prefix")})


def enrich_rows(df: DataFrame, method: str = "chunked", post_code: str | None = "POST",
                pin: bool = False) -> DataFrame:
    """Row-level derivations and ordered scans (see module docstring), with the
    columns that the features read; rows without a customer are left out.

    Nothing is written after the rows in order of time: the one reader of the result,
    the aggregate per customer, takes it where the customers' rows have met.  With
    ``pin`` the result is written as a table, for several readers.
    """
    rows, _ = _enriched(df, method, post_code)
    return materialize(rows) if pin else rows


def _enriched(df: DataFrame, method: str, post_code: str | None = "POST") -> tuple[DataFrame, DataFrame]:
    """The enriched rows, and what the labels read of them (customer, date and total),
    dealt to tasks alike."""
    order = order_cols()
    rows = df.select(
        "order_id", "quantity", "order_date", "price", "customer_id", "total", "line_seq",
        product_prefix("product_id").alias("product_prefix"),
        post_amount("product_id", post_code).alias("post"),
        eu_flag("country").alias("eu"),
        F.when(F.col("country").isNotNull(), F.xxhash64("country")).alias("country_key"),
        _code_key().alias("code_key"),
    )
    placed = None
    if method == "chunked":
        placed = tl.place_in_time(rows, ORDER_KEY, ("product_prefix", PROD_SUMS), ("order_id", ORDER_SUMS), ["order_date", "order_id"])
    position = [F.col(tl.POS)]
    scales, complete = {}, lambda part: part
    if placed is not None:
        counted = placed.rows
        codes = first_seen_code(counted, "country_key", position, name="country_code", method=method)
        if placed.scales is None:  # sums beyond 18 digits
            rows = placed.complete()
        else:  # the sums of earlier rows are added where a customer's rows have met
            scales = placed.scales
            if placed.sent:
                rows, complete = placed.rows, lambda part: placed.complete(part, whole=True)
            else:
                rows = placed.complete(whole=True)
        rows = rows.drop("order_id", "line_seq")
        order_key = tl.RUN
    else:  # the plain plan, and sums of more than 18 digits within one range
        carry = rows.columns
        rows = prefix_scan(rows, ["product_prefix"], order, sums=PROD_SUMS, method=method, keep=carry)
        rows = prefix_scan(rows, ["order_id"], order, sums=ORDER_SUMS, method=method, keep=[*carry, *PROD_SUMS])
        rows = counted = prefix_scan(rows, [], order, row_number=tl.POS, method=method, keep=rows.columns)
        order_key = "order_id"
        codes = first_seen_code(rows, "country_key", position, name="country_code", method=method)
    # one row per country; ranks by first appearance hold for every cut
    rows = rows.join(materialize(codes), "country_key", "left").drop("country_key")
    rows = rows.where(F.col("customer_id").isNotNull())

    def scanned(part: DataFrame, how: str) -> DataFrame:
        part = _begun(complete(part).withColumn("order_ts", epoch_seconds("order_date")), position, order_key)
        return scan_customer(part, CUST_SUMS, DIFFS, position, how, keep=part.columns)

    if method == "chunked":
        total, hot = _many_rows(counted)
        tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // DEALT_ROWS))
    else:
        tasks, hot = None, None
    # all that follows takes the rows as dealt here
    met = lambda part: part.repartition(*([tasks] if tasks else []), "customer_id")
    spend = rows.select("customer_id", "order_date", "total")
    if "total" in scales:
        spend = spend.withColumn("total", tl.with_point("total", df.schema["total"].dataType))
    if hot is not None:  # at most one customer for so many rows
        cold = scanned(met(rows.join(F.broadcast(hot), "customer_id", "left_anti")), "window")
        many = scanned(rows.join(F.broadcast(hot), "customer_id", "left_semi"), "chunked")
        rows = cold.unionByName(many)
    else:
        rows, spend = scanned(met(rows), "window"), met(spend)
    for out, src in {**CUST_SUMS, **PROD_SUMS, **ORDER_SUMS, **DIFFS}.items():
        if src in scales:
            scales = {**scales, out: scales[src]}
    return rows.select(*[F.col(c).alias(c, metadata={_SCALE: scales[c]}) if c in scales else F.col(c) for c in rows.columns]), spend


#: In a column's metadata: its values are whole numbers, with so many digits behind the point.
_SCALE = "scale"


def _scales(enriched: DataFrame) -> dict[str, int]:
    return {f.name: f.metadata[_SCALE] for f in enriched.schema.fields if _SCALE in f.metadata}


def _many_rows(rows: DataFrame) -> tuple[int, DataFrame | None]:
    """The number of rows with a customer, and the customers with more than ``HOT_ROWS``
    (None if there are none).  Groups of customers are counted first, so a table without
    such a customer sends few counts, not one per customer and task."""
    rows = rows.select("customer_id").where(F.col("customer_id").isNotNull())
    grouped = rows.withColumn("_group", F.pmod(F.xxhash64("customer_id"), F.lit(_GROUPS)))
    groups = materialize(grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("n")))  # at most _GROUPS rows
    total, most = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most <= HOT_ROWS:
        return total, None
    among = grouped.join(F.broadcast(groups.where(F.col("n") > HOT_ROWS).select("_group")), "_group", "left_semi")
    hot = materialize(among.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select("customer_id"))
    return total, hot if hot.count() else None


def feature_matrices(df: DataFrame, cuts: list[str], enriched: DataFrame | None = None,
                     max_rows: int = 20, method: str = "chunked") -> DataFrame:
    """``customer_id, as_of`` plus the 124 features for several history cuts, from one
    pass over the enriched rows (all features as double)."""
    cuts = sorted(set(cuts))
    if enriched is None:
        enriched = enrich_rows(history_before(df, cuts[-1]), method)
    rows = enriched.where(F.col("order_date") < month_start(cuts[-1]))
    moments = [c for c, stats in FEATURE_SPEC if set(stats) & {"mean", "max", "min", "sum", "std", "skew"}]
    first, last = ["order_ts"], ["order_ts", "eu", "country_code"]
    partials = pt.month_partials(rows, ["customer_id"], moments, tl.POS, first, last, None, ["code_key"], cuts, _BEGUN, _scales(enriched))
    states = pt.running(partials, ["customer_id"], moments, first, last, list(_BEGUN), ["code_key"], cuts)
    outlier = ((F.col("rows") < max_rows) & product_anomalous(_code_start("least_code_key"))).cast("int")
    feats = {"outlier-last": F.coalesce(outlier, F.lit(0))}
    return pt.at_cuts(states, cuts).select("customer_id", "as_of", *[
        (feats[n] if (n := f"{c}-{s}") in feats else pt.statistic(c, s)).cast("double").alias(n)
        for c, stats in FEATURE_SPEC for s in stats])


def feature_matrix(df: DataFrame, as_of: str, enriched: DataFrame | None = None,
                   max_rows: int = 20, method: str = "chunked") -> DataFrame:
    """``customer_id`` plus the 124 features over rows before month ``as_of``
    (all features as double)."""
    return feature_matrices(df, [as_of], enriched, max_rows, method).drop("as_of")


def _labelled(df: DataFrame, last: str, enriched: DataFrame | None, method: str) -> tuple[DataFrame, DataFrame]:
    """Enriched rows up to the end of month ``last``, and the rows to label months by:
    the same ones, if they are made here, so ``df`` is read once."""
    if enriched is not None:
        return enriched, df
    return _enriched(history_before(df, add_months(last, 1)), method)


def training_set(df: DataFrame, m: str, thr=TOTAL_THRES, enriched: DataFrame | None = None,
                 max_rows: int = 20, method: str = "chunked") -> DataFrame:
    """Labels of the month before ``m`` with features cut at that month."""
    return scoring_set(df, prev_month(m), thr, enriched, max_rows, method)


def training_sets(df: DataFrame, months: Sequence[str], thr=TOTAL_THRES, enriched: DataFrame | None = None,
                  max_rows: int = 20, method: str = "chunked") -> DataFrame:
    """``training_set`` of several months, one below the other: each row's
    features are cut at the month of its label.  The scans run once."""
    labelled = sorted({prev_month(m) for m in months})
    enriched, spend = _labelled(df, labelled[-1], enriched, method)
    labels = month_labels(spend, labelled, thr).select("customer_id", "year_month", "label")
    feats = feature_matrices(df, labelled, enriched, max_rows, method).withColumnRenamed("customer_id", "_customer")
    # by customer alone, as both sides are dealt; the month is compared where they meet
    same = (F.col("customer_id") == F.col("_customer")) & (F.col("year_month") >= F.col("as_of")) & (F.col("year_month") <= F.col("as_of"))
    return labels.join(feats, same, "left").drop("_customer", "as_of")


def scoring_set(df: DataFrame, m: str, thr=TOTAL_THRES, enriched: DataFrame | None = None,
                max_rows: int = 20, method: str = "chunked") -> DataFrame:
    """Spine of month ``m`` with features cut at ``m``."""
    enriched, spend = _labelled(df, m, enriched, method)
    labels = month_label(spend, m, thr, sort=False).select("customer_id", "year_month", "label")
    feats = feature_matrix(df, m, enriched, max_rows, method)
    return labels.join(feats, "customer_id", "left")


def build_datasets(df: DataFrame, m: str, thr=TOTAL_THRES, max_rows: int = 20,
                   method: str = "chunked") -> tuple[DataFrame, DataFrame, list[str]]:
    """Training set (labels of the month before ``m``, features cut there)
    and scoring set (spine of ``m``, features cut at ``m``), and the feature
    names.  The scans run once, both cuts come out of one aggregate, and the
    two sets are halves of one pinned table."""
    pm = prev_month(m)
    both = materialize(training_sets(df, [m, add_months(m, 1)], thr, None, max_rows, method))
    train, score = (both.where(F.col("year_month") == month) for month in (pm, m))
    return train, score, list(FEATURE_NAMES)


STAT_COLUMNS = ("quantity", "price", "total")


def stat_datasets(df: DataFrame, m: str, thr=TOTAL_THRES, columns: Sequence[str] = STAT_COLUMNS,
                  method: str = "chunked") -> tuple[DataFrame, DataFrame, list[str]]:
    """The short form of ``build_datasets``: the seven statistics of a few columns over
    the rows before the label's month, missing values filled with the training set's
    medians; training set, scoring set and feature names."""
    pm = prev_month(m)
    spec = [(c, SEVEN_STATS) for c in columns]
    names = [f"{c}-{s}" for c, stats in spec for s in stats]
    stats = pt.stats_at_cuts(history_before(df, m), spec, [pm, m], name="year_month")
    stats = stats.select("customer_id", "year_month", *[F.col(f"`{n}`").cast("double").alias(n) for n in names])
    sets = materialize(month_labels(df, [pm, m], thr).select("customer_id", "year_month", "label")
                       .join(stats, ["customer_id", "year_month"], "left"))
    train, score = (sets.where(F.col("year_month") == x) for x in (pm, m))
    train, score, _ = impute_median(train, score, names, method=method, stored=True)
    return train, score, names
