"""Aggregate and scalar expressions with the null rules the features need.

* ``sum`` of an all-null group is 0, ``count`` counts non-nulls,
  mean/min/max/std/skew of an all-null group are null.
* ``std`` is the sample deviation (null for one value).
* ``skew`` is the bias-adjusted G1: null below three values, 0 for a constant.
* ``first``/``last`` skip nulls and follow the row order key.
* means of decimals are ``sum / count`` in double, so they are exact up to
  one rounding (``avg`` of a decimal would round to 6 places first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEVEN_STATS = ("mean", "max", "min", "sum", "count", "std", "skew")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def over_threshold(col: Column | str, thr) -> Column:
    """Strict ``col > thr`` as 0/1."""
    return (_c(col) > F.lit(thr)).cast("int")


def coalesce0(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(0))


def clip01(col: Column | str) -> Column:
    return F.least(F.greatest(_c(col), F.lit(0.0)), F.lit(1.0))


def floor0(col: Column | str) -> Column:
    return F.greatest(_c(col), F.lit(0))


def exact_mean(col: Column | str) -> Column:
    c = _c(col)
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0)).cast("double")


def adj_skew(col: Column | str) -> Column:
    c = _c(col)
    n = F.count(c).cast("double")
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.stddev_samp(c) == 0, F.lit(0.0))
            .otherwise(F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)))


def first_value(col: Column | str, order: Sequence[Column]) -> Column:
    """Value on the earliest row where it is not null."""
    c = _c(col)
    return F.min_by(c, F.when(c.isNotNull(), F.struct(*order)))


def last_value(col: Column | str, order: Sequence[Column]) -> Column:
    """Value on the latest row where it is not null."""
    c = _c(col)
    return F.max_by(c, F.when(c.isNotNull(), F.struct(*order)))
