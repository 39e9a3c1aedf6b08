"""Find the stretches of documents that may repeat elsewhere.

A document is a row of units (bytes or words).  A window is ``size`` consecutive
units.  From each window the smallest of its ``gram``-unit seeds is chosen by
hash, so equal windows choose equal seeds and most neighbouring windows share
one.  Seeds travel packed, four bytes each, to hash buckets that tell which
occur more than once; every maximal run of windows whose seeds do is a *run*.
Equal runs collapse before anything else is shuffled, so a passage that a third
of all documents share costs one row from then on.

Nothing is lost here: a repeated window always has a repeated seed.  The 32-bit
remainders may let through a few unrepeated windows, which the operators' exact
steps then find to be alone.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, pin, shuffle_partitions
from .textnum import Words, bytes_prefix, grams, join_runs, leftmost_min, span, text_slices, windows

MAX_ID = (1 << 63) - 1


class Spec(NamedTuple):
    size: int            # units of a window
    gram: int            # units of a seed
    words: bool          # units are words, else bytes
    across: bool         # only repeats in another document count


class View:
    """Units of a slice: hash prefix sums, row offsets, byte places of units."""

    def __init__(self, buf, off, words: bool):
        self.buf, self.words = buf, words
        if words:
            w = Words(buf, off)
            self.pre, self.first, self.start, self.end = w.prefix(), w.first, w.start, w.end
        else:
            self.pre, self.first = bytes_prefix(buf), off

    def cut(self, lo: int, hi: int) -> bytes:
        """The text of units lo to hi."""
        if self.words:
            return self.buf[self.start[lo]:self.end[hi - 1]].tobytes()
        return self.buf[lo:hi].tobytes()


def seeds(view: View, spec: Spec):
    """Seeds of a slice in order: hash, place, first and last window that chose
    it, row."""
    g = grams(view.pre, spec.gram)
    at, per_row = windows(view.first, spec.size)
    a = leftmost_min(g, spec.size - spec.gram + 1)[at] if len(at) else at
    lo, hi = join_runs(a, (a[1:] == a[:-1]) & (at[1:] == at[:-1] + 1))
    row = np.repeat(np.arange(len(per_row)), per_row)
    return g[a[lo]], a[lo], at[lo], at[hi], row[lo]


def _binary(parts) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def _packed(spec: Spec, buckets: int):
    def run(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in text_slices(batch.column("text")):
                h, _, _, _, row = seeds(View(buf, off, spec.words), spec)
                if not len(h):
                    continue
                b = (h % np.uint64(buckets)).astype(np.int64)
                rem = (h // np.uint64(buckets)).astype(np.uint32)
                order = np.argsort(b, kind="stable")
                b, rem, row = b[order], rem[order], row[order]
                out = []
                edge = np.flatnonzero(np.diff(b)) + 1
                for x, y in zip(np.concatenate([[0], edge]), np.concatenate([edge, [len(b)]])):
                    rows, n = np.unique(row[x:y], return_counts=True)
                    out.append((int(b[x]), keys[lo + rows], n.astype(np.uint32), rem[x:y]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), _binary(o[1] for o in out),
                     _binary(o[2] for o in out), _binary(o[3] for o in out)],
                    names=["bucket", "owners", "counts", "rems"])
    return run


def _answers(spec: Spec):
    """For the seeds of each bucket: places, within document and bucket, of
    those that occur again."""
    def answer(bucket, rows):
        rem = np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows])
        n = np.concatenate([np.frombuffer(r[1], np.uint32) for r in rows]).astype(np.int64)
        owner = np.concatenate([np.frombuffer(r[0], np.int64) for r in rows])
        order = np.argsort(rem, kind="stable")
        s = rem[order]
        begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        if spec.across:
            who = np.repeat(owner, n)[order]
            again = np.minimum.reduceat(who, begin) != np.maximum.reduceat(who, begin)
        else:
            again = np.diff(np.concatenate([begin, [len(s)]])) > 1
        hit = np.empty(len(s), bool)
        hit[order] = np.repeat(again, np.diff(np.concatenate([begin, [len(s)]])))
        place = np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n)
        of = np.repeat(np.arange(len(n)), n)[hit]
        place = place[hit].astype(np.uint32)
        edge = np.flatnonzero(np.diff(of)) + 1
        lows, highs = np.concatenate([[0], edge]), np.concatenate([edge, [len(of)]])
        if not len(of):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(owner[of[lows]]), pa.array(np.full(len(lows), bucket, np.int32)),
             _binary(place[x:y] for x, y in zip(lows, highs))], names=["key", "bucket", "places"])

    def run(batches):
        bucket, rows = None, []
        for batch in batches:  # sorted by bucket
            for b, *r in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket and rows:
                    if (out := answer(bucket, rows)) is not None:
                        yield out
                    rows = []
                bucket = b
                rows.append(r)
        if rows and (out := answer(bucket, rows)) is not None:
            yield out
    return run


def _runs(spec: Spec, buckets: int):
    def run(batches):
        for batch in batches:
            keys, ids = batch.column("key").to_numpy(zero_copy_only=False), batch.column("doc_id")
            found = batch.column("found")
            for lo, hi, buf, off in text_slices(batch.column("text")):
                view = View(buf, off, spec.words)
                h, a, s, e, row = seeds(view, spec)
                b = (h % np.uint64(buckets)).astype(np.int64)
                hit = np.zeros(len(h), bool)
                order = np.lexsort((b, row))
                code = row[order] * buckets + b[order]
                for r in range(lo, hi):
                    for one in found[r].as_py():
                        base = np.searchsorted(code, (r - lo) * buckets + one["bucket"])
                        hit[order[base + np.frombuffer(one["places"], np.uint32)]] = True
                k = np.flatnonzero(hit)
                x, y = join_runs(k, (s[k[1:]] == e[k[:-1]] + 1) & (row[k[1:]] == row[k[:-1]]))
                first, last, of = s[k[x]], e[k[y]], row[k[x]]
                ids_of = ids.take(pa.array(lo + of, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[lo + of], pa.int64()), ids_of,
                     pa.array(span(view.pre, first, last + spec.size).view(np.int64)),
                     pa.array(first - view.first[of], pa.int64()), pa.array(last - first + 1, pa.int64()),
                     pa.array([view.cut(p, q + spec.size) for p, q in zip(first, last)], pa.binary())],
                    names=["key", "doc_id", "run", "s", "n", "body"])
    return run


def find_runs(docs: DataFrame, spec: Spec) -> DataFrame:
    """Runs of windows that may repeat: key and doc_id of the document, hash of
    the run, place of its first window, number of windows, its text.  Pinned."""
    spark = docs.sparkSession
    # a quarter of the shuffle's partitions: 4 bytes a seed make small buckets
    buckets = max(12, shuffle_partitions(spark) // 4)
    base = keyed(docs)
    packed = base.select("key", "text").mapInArrow(
        _packed(spec, buckets), "bucket int, owners binary, counts binary, rems binary")
    answers = (packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
               .mapInArrow(_answers(spec), "key long, bucket int, places binary"))
    found = answers.groupBy("key").agg(F.collect_list(F.struct("bucket", "places")).alias("found"))
    runs = base.join(found, "key").mapInArrow(
        _runs(spec, buckets), "key long, doc_id long, run long, s long, n long, body binary")
    return pin(runs, "zstd")


def cover(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Boolean array of ``n`` units; true within any [lo, hi)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, lo, 1)
    np.add.at(d, hi, -1)
    return np.cumsum(d[:-1]) > 0
