"""Best-fit packing of tokenised documents into fixed-size sequences.

Lengths are at most the capacity, so the whole plan depends on a histogram of
that many counts: large pieces (over a third of the capacity) are matched at most
two to a bin, the largest with the largest that fits; smaller ones fill the
smallest remaining gap.  The driver plans on counts; the pieces then find their
place from their rank among the pieces of the same length.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import id_text, pin

CAPACITY = 1024
END = 2
VOCABULARY = "byte_bpe_50k"
_CACHE_MOST = 200_000
_ODD = re.compile(r"\s |^ | \s| $")
_SPECIAL = "<|endoftext|>"


class _Encoder:
    """Ids of a text as little-endian 32-bit bytes.  A single space between two
    other characters always begins a token, so words are encoded one by one and
    cached; other texts are encoded whole."""

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.path = public_tokenizers.path(f"{vocabulary}.json")
        self.whole = None
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.words = {}

    def _bytes(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if _SPECIAL in text:  # the special token, as the tokenizer's file has it
            if self.whole is None:
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.path)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _ODD.search(text):
            return self._bytes(text)
        first, *rest = text.split(" ")
        words, out = self.words, [self._bytes(first)]
        if len(words) > _CACHE_MOST:
            words.clear()
        for w in rest:
            ids = words.get(w)
            if ids is None:
                ids = words[w] = self._bytes(" " + w)
            out.append(ids)
        return b"".join(out)


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(vocabulary: str) -> _Encoder:
    """One encoder for the life of a Python worker."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = _Encoder(vocabulary)
    return _ENCODERS[vocabulary]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"


def _pieces(vocabulary: str, capacity: int):
    """Pieces with their rank among those of the same length in this task."""
    def run(batches):
        from pyspark import TaskContext
        encode, seen = _encoder(vocabulary), [0] * (capacity + 1)
        part = TaskContext.get().partitionId()
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text) + end
                n = len(ids) // 4
                first = n % capacity or min(n, capacity)
                lo, hi, k = 0, first, 0
                while lo < n:
                    size = hi - lo
                    out.append((doc, k, lo, size, zlib.crc32(ids[4 * lo:4 * hi]), part, seen[size]))
                    seen[size] += 1
                    lo, hi, k = hi, hi + capacity, k + 1
            cols = list(zip(*out)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             names=[c.split()[0] for c in _PIECE.split(", ")])
    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Place ``counts[length]`` pieces.  Returns steps (length, first rank, first
    sequence, pieces to a sequence, offset): the piece of rank r of that length,
    from the step's first rank on, goes to sequence first + (r - rank) // per at
    offset + (r - rank) % per * length.  Steps of a length come by rank."""
    steps: list[tuple[int, int, int, int, int]] = []
    left, rank, sequences = dict(counts), {n: 0 for n in counts}, 0
    bins: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
    gaps: list[int] = []

    def opened(gap, first, n):
        if n and gap:
            if gap not in bins:
                bins[gap] = []
                bisect.insort(gaps, gap)
            bins[gap].append((first, n))

    def put(size, n, first, per, offset):
        steps.append((size, rank[size], first, per, offset))
        rank[size] += n
        left[size] -= n

    large = sorted(n for n, c in counts.items() if 3 * n > capacity and c)
    while large:
        a = large[-1]
        k = bisect.bisect_right(large, capacity - a) - 1
        if k >= 0 and large[k] == a and left[a] == 1:
            k -= 1  # an odd last one goes with the next shorter
        b = large[k] if k >= 0 else None
        if b is None:
            n = left[a]
            put(a, n, sequences, 1, 0)
            opened(capacity - a, sequences, n)
        elif a == b:
            n = left[a] // 2
            put(a, 2 * n, sequences, 2, 0)
            opened(capacity - 2 * a, sequences, n)
        else:
            n = min(left[a], left[b])
            put(a, n, sequences, 1, 0)
            put(b, n, sequences, 1, a)
            opened(capacity - a - b, sequences, n)
        sequences += n
        large = [x for x in large if left[x]]
    for size in sorted((n for n, c in counts.items() if 3 * n <= capacity and c), reverse=True):
        while left[size]:
            k = bisect.bisect_left(gaps, size)
            if k == len(gaps):
                per = capacity // size
                n = left[size]
                full, some = divmod(n, per)
                put(size, n, sequences, per, 0)
                opened(capacity - per * size, sequences, full)
                opened(capacity - some * size, sequences + full, 1 if some else 0)
                sequences += full + (some > 0)
                continue
            gap = gaps[k]
            first, many = bins[gap].pop()
            if not bins[gap]:
                del bins[gap]
                gaps.pop(k)
            per = gap // size
            n = min(left[size], per * many)
            full, some = divmod(n, per)
            put(size, n, first, per, capacity - gap)
            opened(gap - per * size, first, full)
            if some:
                opened(gap - some * size, first + full, 1)
            used = full + (some > 0)
            opened(gap, first + used, many - used)
    return steps


def _place(steps, capacity: int):
    table = {}
    for size, *rest in steps:
        table.setdefault(size, []).append(rest)
    table = {k: np.array(v, np.int64) for k, v in table.items()}

    def run(batches):
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("at").to_numpy()
            seq, offset = np.empty(len(size), np.int64), np.empty(len(size), np.int64)
            for n in np.unique(size):
                i = np.flatnonzero(size == n)
                t = table[int(n)]
                s = t[np.searchsorted(t[:, 0], rank[i], "right") - 1]
                j = rank[i] - s[:, 0]
                seq[i], offset[i] = s[:, 1] + j // s[:, 2], s[:, 3] + j % s[:, 2] * n
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")] + [pa.array(seq), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.

    Null and empty texts are the end token alone; documents longer than the
    capacity are cut, the first piece taking the remainder; each of several equal
    rows is packed; an empty table gives an empty result."""
    pieces = pin(id_text(docs).mapInArrow(_pieces(vocabulary, capacity), _PIECE))
    by_part = pin(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("k")))
    before = by_part.withColumn("before", F.sum("k").over(
        W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    counts = {r.length: r.k for r in by_part.groupBy("length").agg(F.sum("k").alias("k")).collect()}  # at most ``capacity`` rows
    steps = plan(counts, capacity)
    ranked = (pieces.join(before.select("length", "part", F.coalesce("before", F.lit(0)).alias("before")), ["length", "part"])
              .withColumn("at", F.col("rank") + F.col("before")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "at").mapInArrow(
        _place(steps, capacity),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
