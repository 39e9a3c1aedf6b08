"""Mergeable statistics per key and month, and their merge along the months.

``month_partials`` reads the rows once and keeps, for each key and month, what any later
cut needs: counts, exact sums, extremes, central moments (M2, M3) and first and last
values; if the cuts are known, months between two cuts share a row, so one cut alone has
one row per key and needs no merge.  ``running`` merges the rows in order of time, so the
state after one is the statistics of all rows up to its end: the pairwise formulas for two
samples are sums along the months once the state before each is known, hence three passes
of running sums over one sort.  A cut takes each key's state before its month; rows are
never sent to cuts, however many there are.

All buffers have a fixed width (first and last go by a row number, not by a struct), so
the partial statistics are a hash aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendcast.functions.periods import month_start

MONTH = "_month"


def month_index(col: Column | str = "order_date") -> Column:
    """Months since the year 0, as an integer."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def month_number(m: str) -> int:
    """``month_index`` of a ``'YYYY-MM'`` string."""
    year, month = m.split("-")
    return int(year) * 12 + int(month) - 1


def _as_double(c: str, scale: int) -> Column:
    """The double nearest to the whole number ``c`` with its point, as a cast of the decimal gives it."""
    v = F.col(c)
    return F.when(F.abs(v) < F.lit(1 << 52), v.cast("double") / F.lit(float(10 ** scale))).otherwise(
        (v.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))).cast("double"))


def _halves(c: str) -> tuple[Column, Column]:
    """Upper and lower bits of a whole number: their sums fit 64 bits for up to 2^31 rows."""
    return F.shiftright(F.col(c), 31), F.col(c).bitwiseAND(F.lit((1 << 31) - 1))


def _joined(high: str, low: str, scale: int) -> Column:
    whole = F.col(high).cast("decimal(20,0)") * F.lit(Decimal(1 << 31)) + F.col(low).cast("decimal(20,0)")
    return (whole * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(38,{scale})")


def month_partials(df: DataFrame, keys: Sequence[str], columns: Sequence[str], pos: str | None = None,
                   first: Sequence[str] = (), last: Sequence[str] = (), distinct: Mapping[str, str] | None = None,
                   least: Sequence[str] = (), cuts: Sequence[str] = (), begun: Mapping[str, str] | None = None,
                   scales: Mapping[str, int] | None = None) -> DataFrame:
    """One row per key and month (``_month``); with ``cuts`` one per key and stretch
    between two of them, under its last month, and none from the last cut on.

    For each of ``columns`` n, s (sum in the column's own type), lo, hi, m2 and m3; for
    ``first`` and ``last`` the value at the least and greatest ``pos`` where it is not
    null (fixed-width types); for ``distinct`` (name -> column) how many values come up
    for the first time, as for ``begun`` (name -> column), whose columns are 1 on the row
    where a value does so and 0 elsewhere; for ``least`` the minimum; ``rows``.  Keys with nulls are left
    out.  ``scales``: columns whose values are whole numbers of 64 bits, with their digits behind the point."""
    month = month_index()
    if cuts:
        month = None
        for c in sorted(set(cuts)):
            before, last_month = F.col("order_date") < month_start(c), F.lit(month_number(c) - 1)
            month = F.when(before, last_month) if month is None else month.when(before, last_month)
    rows = df.withColumn(MONTH, month).where(F.col(MONTH).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    aggs = [F.count(F.lit(1)).alias("rows")]
    scales = scales or {}
    for c in columns:
        d = _as_double(c, scales[c]) if c in scales else F.col(c).cast("double")
        sums = [F.sum(part).alias(f"{x}_{c}") for x, part in zip(("high", "low"), _halves(c))] if c in scales else [F.sum(c).alias(f"s_{c}")]
        aggs += [F.count(c).alias(f"n_{c}"), *sums, F.min(d).alias(f"lo_{c}"), F.max(d).alias(f"hi_{c}"),
                 F.var_pop(d).alias(f"v_{c}"), F.skewness(d).alias(f"g_{c}")]
    known = lambda c: F.when(F.col(c).isNotNull(), F.col(pos))
    aggs += [F.min_by(F.col(c), known(c)).alias(f"first_{c}") for c in first]
    aggs += [F.max_by(F.col(c), known(c)).alias(f"last_{c}") for c in last]
    aggs += [F.min(c).alias(f"least_{c}") for c in least]
    aggs += [F.sum(c).alias(f"new_{name}") for name, c in (begun or {}).items()]
    out = rows.groupBy(*keys, MONTH).agg(*aggs)
    for c in columns:
        if c in scales:
            out = out.withColumn(f"s_{c}", _joined(f"high_{c}", f"low_{c}", scales[c])).drop(f"high_{c}", f"low_{c}")
    for c in columns:  # central moments as sums; of equal values exactly 0
        n, v = F.col(f"n_{c}"), F.col(f"v_{c}")
        varied = F.col(f"lo_{c}") < F.col(f"hi_{c}")
        out = out.withColumns({f"m2_{c}": F.when(varied, v * n).otherwise(F.lit(0.0)),
                               f"m3_{c}": F.when(varied, F.col(f"g_{c}") * v * F.sqrt(v) * n).otherwise(F.lit(0.0))}).drop(f"v_{c}", f"g_{c}")
    for name, c in (distinct or {}).items():
        begun = (rows.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.min(MONTH).alias(MONTH))
                 .groupBy(*keys, MONTH).agg(F.count(F.lit(1)).alias(f"new_{name}")))
        out = out.join(begun, [*keys, MONTH], "left").withColumn(f"new_{name}", F.coalesce(f"new_{name}", F.lit(0)))
    return out


def running(partials: DataFrame, keys: Sequence[str], columns: Sequence[str], first: Sequence[str] = (),
            last: Sequence[str] = (), distinct: Sequence[str] = (), least: Sequence[str] = (),
            cuts: Sequence[str] = ()) -> DataFrame:
    """The partials merged up to and including each month, under the same names, and
    ``_until``, the key's next month with rows (null for its last).  A key has one row
    for each of its months, so a window holds no more than the history has months."""
    order = Window.partitionBy(*keys).orderBy(MONTH)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {f"t_{c}": F.sum(c).over(upto) for c in ["rows"] + [f"{x}_{c}" for c in columns for x in ("n", "s")] + [f"new_{c}" for c in distinct]}
    ends = {f"t_lo_{c}": F.min(f"lo_{c}").over(upto) for c in columns} | {f"t_hi_{c}": F.max(f"hi_{c}").over(upto) for c in columns}
    ends |= {f"t_first_{c}": F.first(f"first_{c}", ignorenulls=True).over(upto) for c in first}
    ends |= {f"t_last_{c}": F.last(f"last_{c}", ignorenulls=True).over(upto) for c in last}
    ends |= {f"t_least_{c}": F.min(f"least_{c}").over(upto) for c in least}
    out = partials.withColumns({**sums, **ends, "_until": F.lead(MONTH).over(order)})
    out = out.withColumns({f"before_{c}": F.lag(f"t_s_{c}").over(order) for c in columns})
    zero = F.lit(0.0)
    step2, step3 = {}, {}
    for c in columns:
        n = F.col(f"n_{c}").cast("double")
        whole = F.col(f"t_n_{c}").cast("double")
        old = whole - n
        both = (n > 0) & (old > 0)
        # from the mean of the months before to that of this month
        move = F.when(both, F.col(f"s_{c}").cast("double") / n - F.col(f"before_{c}").cast("double") / old).otherwise(zero)
        step2[f"d_{c}"] = move
        step3[f"e_{c}"] = F.when(both, F.col(f"d_{c}") * F.col(f"d_{c}") * old * n / whole).otherwise(zero)
    out = out.withColumns(step2).withColumns(step3)
    out = out.withColumns({f"t_m2_{c}": F.sum(F.col(f"m2_{c}") + F.col(f"e_{c}")).over(upto) for c in columns})
    out = out.withColumns({f"o_{c}": F.coalesce(F.lag(f"t_m2_{c}").over(order), zero) for c in columns})
    step = {}
    for c in columns:
        n, whole, d = F.col(f"n_{c}").cast("double"), F.col(f"t_n_{c}").cast("double"), F.col(f"d_{c}")
        old = whole - n
        cross = d * d * d * old * n * (old - n) / (whole * whole) + 3.0 * d * (old * F.col(f"m2_{c}") - n * F.col(f"o_{c}")) / whole
        step[f"t_m3_{c}"] = F.sum(F.col(f"m3_{c}") + F.when((n > 0) & (old > 0), cross).otherwise(zero)).over(upto)
    out = out.withColumns(step)
    names = (["rows"] + [f"{x}_{c}" for c in columns for x in ("n", "s", "lo", "hi", "m2", "m3")] + [f"new_{c}" for c in distinct]
             + [f"first_{c}" for c in first] + [f"last_{c}" for c in last] + [f"least_{c}" for c in least])
    return out.select(*keys, MONTH, "_until", *[F.col(f"t_{c}").alias(c) for c in names])


def at_cuts(states: DataFrame, cuts: Sequence[str], name: str = "as_of") -> DataFrame:
    """The state of each key before each of the months ``cuts`` (keys without earlier
    rows have none)."""
    table = F.array(*[F.struct(F.lit(c).alias("m"), F.lit(month_number(c)).alias("i")) for c in sorted(set(cuts))])
    holds = lambda x: (F.col(MONTH) < x["i"]) & (F.col("_until").isNull() | (x["i"] <= F.col("_until")))
    return states.select("*", F.explode(F.filter(table, holds)).alias("_cut")).withColumn(name, F.col("_cut.m")).drop("_cut", MONTH, "_until")


def statistic(c: str, stat: str) -> Column:
    """A statistic of ``c`` from its merged state (null rules of ``functions.stats``)."""
    n = F.col(f"n_{c}").cast("double")
    m2 = F.when(F.col(f"lo_{c}") < F.col(f"hi_{c}"), F.col(f"m2_{c}")).otherwise(F.lit(0.0))
    if stat == "count":
        return F.col(f"n_{c}")
    if stat == "sum":
        return F.coalesce(F.col(f"s_{c}"), F.lit(0))
    if stat == "mean":
        return F.when(n > 0, F.col(f"s_{c}").cast("double") / n)
    if stat in ("min", "max"):
        return F.col(f"{'lo' if stat == 'min' else 'hi'}_{c}")
    if stat == "std":
        return F.when(n > 1, F.sqrt(m2 / (n - 1)))
    if stat == "skew":
        skew = F.sqrt(n) * F.col(f"m3_{c}") / (m2 * F.sqrt(m2)) * F.sqrt(n * (n - 1)) / (n - 2)
        return F.when(n < 3, F.lit(None).cast("double")).when(m2 == 0, F.lit(0.0)).otherwise(skew)
    if stat == "nunique":
        return F.col(f"new_{c}")
    if stat in ("first", "last"):
        return F.col(f"{stat}_{c}")
    raise ValueError(f"unknown statistic {stat!r}")


def stats_at_cuts(df: DataFrame, spec: Sequence[tuple[str, Sequence[str]]], cuts: Sequence[str],
                  keys: Sequence[str] = ("customer_id",), name: str = "as_of") -> DataFrame:
    """``keys``, ``as_of`` and ``{col}-{stat}`` over the rows before each cut, for the
    seven statistics."""
    columns = [c for c, _ in spec]
    states = running(month_partials(df, keys, columns, cuts=cuts), keys, columns, cuts=cuts)
    return at_cuts(states, cuts, name).select(*keys, name, *[statistic(c, s).alias(f"{c}-{s}") for c, stats in spec for s in stats])
