"""Per-customer statistics: the seven-statistic block, distinct counts,
first/last values, postage.

Plan: the statistics are split over aggregates that Spark runs well, then
joined on the (already hash-partitioned) key:

* *exact* -- decimal sums, counts, first/last by the row order.  Decimal
  sums and struct orderings are not fixed-width buffers, so this one is a
  sort-based aggregate; it is kept narrow.
* *moments* -- min, max, sample std and adjusted skew over the values as
  double (min/max of a decimal cast to double equals the cast of its
  min/max).  Fixed-width buffers: a hash aggregate.
* *distinct* -- distinct counts in their own aggregate (mixed with the
  others they would make Spark expand every row once per distinct column).

All of them merge partial buffers, so a customer with many rows is reduced
on the map side before the shuffle.  Means are exact ``sum / count``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendcast.functions.stats import SEVEN_STATS, adj_skew, first_value, floor0, last_value
from spendcast.sources.transactions import order_cols


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def customer_stats(df: DataFrame, spec: Sequence[tuple[str, Sequence[str]]],
                   keys: Sequence[str] = ("customer_id",),
                   order: Sequence[Column] | None = None,
                   extra: dict[str, Column] | None = None,
                   sources: dict[str, str] | None = None) -> DataFrame:
    """``keys`` plus ``{col}-{stat}`` for each ``(col, stats)`` of ``spec``.

    Statistics: mean max min sum count std skew first last nunique.
    ``extra`` are further named aggregates (kept under their names) for the
    exact aggregate;
    ``sources`` maps a feature column name to the data column it reads.
    """
    keys = list(keys)
    order = list(order or order_cols())
    sources = sources or {}
    extra = dict(extra or {})
    exact, moments, distinct, out = {}, {}, {}, []
    for c, stats in spec:
        src = F.col(sources.get(c, c))
        for s in stats:
            name = f"{c}-{s}"
            if s in ("sum", "mean", "count"):
                exact[f"_sum_{c}"] = F.sum(src)
                exact[f"_cnt_{c}"] = F.count(src)
                if s == "sum":
                    expr = F.coalesce(_q(f"_sum_{c}"), F.lit(0))
                elif s == "count":
                    expr = _q(f"_cnt_{c}")
                else:
                    expr = (_q(f"_sum_{c}").cast("double")
                            / F.nullif(_q(f"_cnt_{c}"), F.lit(0)).cast("double"))
            elif s in ("first", "last"):
                exact[name] = (first_value if s == "first" else last_value)(src, order)
                expr = _q(name)
            elif s in ("min", "max", "std", "skew"):
                d = src.cast("double")
                moments[name] = {"min": F.min, "max": F.max, "std": F.stddev_samp,
                                 "skew": adj_skew}[s](d)
                expr = _q(name)
            elif s == "nunique":
                distinct[name] = F.count_distinct(src)
                expr = _q(name)
            else:
                raise ValueError(f"unknown statistic {s!r}")
            out.append(expr.alias(name))
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    rows = df.where(nn)
    parts = []
    if exact or extra:
        parts.append(rows.groupBy(*keys).agg(*[e.alias(n) for n, e in {**exact, **extra}.items()]))
    if moments:
        parts.append(rows.groupBy(*keys).agg(*[e.alias(n) for n, e in moments.items()]))
    if distinct:
        parts.append(rows.groupBy(*keys).agg(*[e.alias(n) for n, e in distinct.items()]))
    joined = parts[0]
    for p in parts[1:]:
        joined = joined.join(p, keys)
    return joined.select(*keys, *out, *[_q(n) for n in extra])


def stat_features(df: DataFrame, cols: Iterable[str] = ("quantity", "price", "total"),
                  keys: Sequence[str] = ("customer_id",),
                  stats: Sequence[str] = SEVEN_STATS) -> DataFrame:
    """``{col}-{stat}`` for every column and statistic, per key."""
    return customer_stats(df, [(c, tuple(stats)) for c in cols], keys)


def distinct_counts(df: DataFrame, cols: dict[str, str] | None = None) -> DataFrame:
    """Distinct orders and product families per customer."""
    cols = cols or {"order_id-nunique": "order_id", "product_id-nunique": "product_prefix"}
    return (df.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
            .agg(*[F.count_distinct(src).alias(out) for out, src in cols.items()]))


def first_last(df: DataFrame, first: Iterable[str] = ("order_ts",),
               last: Iterable[str] = ("order_ts", "country", "eu")) -> DataFrame:
    """Earliest / latest non-null values per customer in the row order."""
    order = order_cols()
    return (df.where(F.col("customer_id").isNotNull()).groupBy("customer_id")
            .agg(*[first_value(c, order).alias(f"{c}-first") for c in first],
                 *[last_value(c, order).alias(f"{c}-last") for c in last]))


def post_amount(product_col: str = "product_id", code: str | None = "POST") -> Column:
    """Row-level postage: the non-negative line total on ``code`` rows, else
    0.  ``code=None`` counts every row (the literal original behaviour)."""
    amount = floor0("total")
    if code is None:
        return amount
    return F.when(F.col(product_col) == code, amount).otherwise(F.lit(0)).cast("decimal(18,2)")


def post_spend(df: DataFrame, code: str | None = "POST") -> DataFrame:
    """Per customer, the sum of non-negative totals on ``code`` rows."""
    rows = df.where(F.col("customer_id").isNotNull())
    if code is not None:
        rows = rows.where(F.col("product_id") == code)
    return (rows.groupBy("customer_id")
            .agg(F.sum(floor0("total")).cast("double").alias("post")))

