"""Ordered scans per key (running sums, previous-row values, row numbers)
that stay balanced when one key holds a large share of all rows.

``method="window"`` is the textbook plan: one hash exchange on the key and a
window per key.  A key with a third of all rows then lands in one task.

``method="chunked"`` is a distributed prefix scan:

1. range-partition by ``(key, order)`` into ``n`` chunks, so a hot key is cut
   into many contiguous chunks; the chunk id is pinned with the rows in a Parquet
   table (it must not change if a task is retried), which holds the columns that
   the caller asks for (``keep``) and those that the scan reads, and no others;
2. for the keys that cross a chunk edge (the lowest and highest key of each
   chunk, at most ``2n`` (key, chunk) pairs) aggregate per-chunk sums, counts
   and last values, and run the scan over those few rows;
3. broadcast that table (at most ``n`` rows with a predecessor chunk, a bound
   set by the partition count, not by the data) and finish with a window per
   ``(key, chunk)``, whose partitions are at most one range chunk.

The chunked plan is the default at every size; the window plan stays as the
check for it in the tests and the bench.  Both have one schema (row numbers are
``bigint``), and running sums take integer and decimal columns only: a sum of
doubles would depend on how the rows are cut.

Null semantics follow the pandas originals: a running sum is null where its
input is null and skips nulls otherwise; a lag is the previous row's value
(null on the key's first row); rows with a null key get null results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendcast.session import pin

_CHUNK = "_scan_chunk"
_ALL = "_scan_all"


def _as_cols(xs: Sequence[Column | str]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def materialize(df: DataFrame) -> DataFrame:
    """Written table (in the session's checkpoint directory): cuts the lineage
    before a result is read many times (medians, model fits)."""
    return pin(df, "zstd")


def _sum_type(df: DataFrame, col: str):
    if df.select(col).dtypes[0][1] in ("float", "double"):
        raise ValueError(f"running sums need an integer or decimal column; cast {col!r} first")
    return df.select(F.sum(col).alias("s")).schema["s"].dataType


def prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                sums: Mapping[str, str] | None = None,
                lags: Mapping[str, str] | None = None,
                row_number: str | None = None,
                method: str = "chunked", num_chunks: int | None = None,
                keep: Sequence[str] | None = None) -> DataFrame:
    """Add running sums (``sums``: out -> input column), previous-row values
    (``lags``: out -> input column) and a 1-based ``row_number`` per key.

    ``order`` must be a total order within each key for sums and lags to be
    deterministic.  ``keys=[]`` scans the whole table as one group.  ``keep``: the
    columns of ``df`` in the result (all by default); others are not carried along.
    """
    sums = dict(sums or {})
    lags = dict(lags or {})
    keys = list(keys)
    order = _as_cols(order)
    sum_types = {out: _sum_type(df, src) for out, src in sums.items()}
    if not keys:
        df = df.withColumn(_ALL, F.lit(0))
        keys = [_ALL]
    if keep is not None:
        made = {f"_scan_o{i}": o for i, o in enumerate(order)}
        used = dict.fromkeys([*keep, *keys, *sums.values(), *lags.values()])
        df = df.select(*used, *[o.alias(c) for c, o in made.items()])
        order = _as_cols(list(made))
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()

    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new = {name: F.when(key_ok & F.col(src).isNotNull(), F.sum(src).over(run))
               .cast(sum_types[name]) for name, src in sums.items()}
        new.update({name: F.when(key_ok, F.lag(src, 1).over(w)) for name, src in lags.items()})
        if row_number:
            new[row_number] = F.when(key_ok, F.row_number().over(w).cast("long"))
        out = df.withColumns(new).drop(_ALL)
        return out if keep is None else out.select(*keep, *new)
    if method != "chunked":
        raise ValueError(f"unknown method {method!r}")

    n = num_chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = pin(df.repartitionByRange(n, *[F.col(k) for k in keys], *order)
                 .withColumn(_CHUNK, F.spark_partition_id()))

    key_struct = F.struct(*[F.col(k) for k in keys])
    edges = ranged.groupBy(_CHUNK).agg(F.min(key_struct).alias("_lo"),
                                       F.max(key_struct).alias("_hi"))
    edge_rows = (ranged.join(F.broadcast(edges), _CHUNK)
                 .where(key_ok & ((key_struct == F.col("_lo")) | (key_struct == F.col("_hi")))))
    ord_struct = F.struct(*order)
    aggs = [F.sum(src).alias(f"_s_{out}") for out, src in sums.items()]
    aggs += [F.max_by(F.col(src), ord_struct).alias(f"_l_{out}") for out, src in lags.items()]
    aggs += [F.count(F.lit(1)).alias("_n")]
    per_chunk = edge_rows.groupBy(*keys, _CHUNK).agg(*aggs)

    cw = Window.partitionBy(*keys).orderBy(_CHUNK)
    before = cw.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(
        *keys, _CHUNK,
        *[F.sum(f"_s_{out}").over(before).alias(f"_o_{out}") for out in sums],
        *[F.lag(f"_l_{out}", 1).over(cw).alias(f"_c_{out}") for out in lags],
        F.sum("_n").over(before).alias("_o_n"),
    ).where(F.col("_o_n").isNotNull())

    joined = ranged.join(F.broadcast(carry), [*keys, _CHUNK], "left")
    w = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rn = F.row_number().over(w)
    new = {}
    for name, src in sums.items():
        total = F.coalesce(F.col(f"_o_{name}"), F.lit(0)) + F.sum(src).over(run)
        new[name] = F.when(key_ok & F.col(src).isNotNull(), total).cast(sum_types[name])
    for name, src in lags.items():
        new[name] = F.when(key_ok, F.when(rn == 1, F.col(f"_c_{name}"))
                           .otherwise(F.lag(src, 1).over(w)))
    if row_number:
        new[row_number] = F.when(key_ok, F.coalesce(F.col("_o_n"), F.lit(0)) + rn)
    out = joined.withColumns(new)
    if keep is not None:
        return out.select(*keep, *new)
    helper = [c for c in out.columns if c.startswith(("_o_", "_c_"))] + [_CHUNK, _ALL]
    return out.drop(*helper)


def running_sums(df: DataFrame, key: str | Sequence[str], cols: Mapping[str, str],
                 order: Sequence[Column | str], method: str = "chunked",
                 keep: Sequence[str] | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return prefix_scan(df, keys, order, sums=cols, method=method, keep=keep)


def global_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                name: str = "rank", method: str = "chunked") -> DataFrame:
    """1-based position of each row within its key in ``order`` (ties broken
    arbitrarily), computed without a single-task window."""
    return prefix_scan(df, keys, order, row_number=name, method=method)
