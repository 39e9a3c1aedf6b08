"""Mergeable sketches per key and month: quantiles (KLL) and distinct counts (HLL).

A sketch is a binary column of bounded size.  Months are sketched once; any range of
months is the merge of theirs, without the rows.  The exact ways are
``explore.quantile`` and ``stats.distinct_counts``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_K = 400
HLL_LG = 12


def rank_bound(k: int = KLL_K) -> float:
    """Rank error, as a share of the rows, that a KLL sketch keeps to with a chance of
    99 % (2.296 / k ** 0.9021, the published fit for one-sided queries)."""
    return 2.296 / k ** 0.9021


def distinct_bound(lg: int = HLL_LG) -> float:
    """Relative error of an HLL estimate: five standard errors of 1.04 / sqrt(2 ** lg)."""
    return 5 * 1.04 / math.sqrt(1 << lg)


def quantile_sketches(df: DataFrame, keys: Sequence[str], col: str, k: int = KLL_K, name: str = "sketch") -> DataFrame:
    """``keys`` and a sketch of ``col`` (as double; nulls are left out)."""
    return df.where(F.col(col).isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(col).cast("double"), F.lit(k)).alias(name))


def merge_quantiles(sketches: DataFrame, keys: Sequence[str] = (), name: str = "sketch", k: int = KLL_K) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(name, F.lit(k)).alias(name))


def sketch_quantile(sketch: Column | str, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(q))


def distinct_sketches(df: DataFrame, keys: Sequence[str], col: str, lg: int = HLL_LG, name: str = "sketch") -> DataFrame:
    """``keys`` and a sketch of the distinct values of ``col`` (nulls are none)."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, lg).alias(name))


def merge_distinct(sketches: DataFrame, keys: Sequence[str] = (), name: str = "sketch") -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_union_agg(name).alias(name))
