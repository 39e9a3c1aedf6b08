"""Month/day keys and point-in-time cuts.

Cuts compare ``order_date`` with a literal ``timestamp_ntz`` bound, so they
are constant-folded and pushed into the Parquet scan; a formatted-string
comparison would not push down.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_key(col: Column | str = "order_date") -> Column:
    """``'YYYY-MM'`` of a timestamp."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyy-MM")


def day_key(col: Column | str = "order_date") -> Column:
    """``'YYYY-MM-DD'`` of a timestamp."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyy-MM-dd")


def with_month(df: DataFrame, name: str = "year_month") -> DataFrame:
    return df.withColumn(name, month_key("order_date"))


def with_day(df: DataFrame, name: str = "year_month_day") -> DataFrame:
    return df.withColumn(name, day_key("order_date"))


def _parse_month(m: str) -> tuple[int, int]:
    d = _dt.datetime.strptime(m, "%Y-%m")
    return d.year, d.month


def add_months(m: str, k: int) -> str:
    """Shift a ``'YYYY-MM'`` string by ``k`` months (driver-side constant)."""
    y, mo = _parse_month(m)
    idx = y * 12 + (mo - 1) + k
    return f"{idx // 12:04d}-{idx % 12 + 1:02d}"


def prev_month(m: str) -> str:
    return add_months(m, -1)


def prev_month_col(col: Column) -> Column:
    """Column form of :func:`prev_month` for month strings held in data."""
    return F.date_format(F.add_months(F.to_date(col, "yyyy-MM"), -1), "yyyy-MM")


def month_start(m: str) -> Column:
    """First instant of month ``m`` as a ``timestamp_ntz`` literal."""
    y, mo = _parse_month(m)
    return F.lit(f"{y:04d}-{mo:02d}-01 00:00:00").cast("timestamp_ntz")


def history_before(df: DataFrame, m: str) -> DataFrame:
    """Rows strictly before the first instant of month ``m``."""
    return df.where(F.col("order_date") < month_start(m))


def in_month(df: DataFrame, m: str) -> DataFrame:
    """Rows of month ``m`` (half-open range, pushes down)."""
    return df.where((F.col("order_date") >= month_start(m))
                    & (F.col("order_date") < month_start(add_months(m, 1))))


def epoch_seconds(col: Column | str = "order_date") -> Column:
    """Seconds since 1970-01-01 as double; independent of the session zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            c.cast("timestamp_ntz")).cast("double")
