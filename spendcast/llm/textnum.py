"""Vectorised hashing of Arrow text columns: bytes, words and their k-grams.

All hashes are polynomial prefix sums modulo 2**64, so the hash of any span is
two lookups, followed by a bit mixer.  They depend on the hashed content alone,
never on where a slice of the column begins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)  # odd, 5 modulo 8
_INV = U(pow(int(_BASE), -1, 1 << 64))
_TABLE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) | U(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_TABLE_LOWER = _TABLE[_LOWER]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

_POWERS = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    have = _POWERS.get("n", -1)
    if have < n:
        size = max(n, 1 << 16)
        for name, b in (("up", _BASE), ("down", _INV)):
            p = np.full(size, b)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
        _POWERS["n"] = size
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Murmur-style finaliser."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums for ``span``; ``values`` are uint64."""
    up, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def span(pre: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of values[lo:hi] for every pair; equal spans give equal hashes."""
    _, down = powers(len(pre))
    return mix((pre[hi] - pre[lo]) * down[lo] + (hi - lo).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def grams(pre: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` values, by start."""
    n = max(0, len(pre) - k)
    _, down = powers(len(pre))
    return mix((pre[k:k + n] - pre[:n]) * down[:n] + U(k * 0xD6E8FEB86659FD93 % (1 << 64)))


def bytes_prefix(buf: np.ndarray) -> np.ndarray:
    return prefix(_TABLE[buf])


def text_slices(column, most: int = 1 << 21):
    """Cut a string column into runs of rows of about ``most`` bytes.  Yields
    (first row, row after the last, bytes, offsets of the rows within them);
    null counts as empty.  A single longer text is a slice of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


class Words:
    """Words of a slice: runs of bytes outside ``space`` (ASCII white space).

    start, end: byte places of each word; first: index of each row's first word
    (one entry more than rows); row: the row of each word; hash: 64-bit hash.
    """

    def __init__(self, buf: np.ndarray, off: np.ndarray, lower: bool = False, space: np.ndarray = IS_SPACE):
        n = len(buf)
        inside = ~space[buf]
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            full = off[1:] > off[:-1]
            begins[off[:-1][full]] = inside[off[:-1][full]]
            ends[off[1:][full] - 1] = inside[off[1:][full] - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(off) - 1), self.count)
        self.hash = span(prefix((_TABLE_LOWER if lower else _TABLE)[buf]), self.start, self.end)

    def prefix(self) -> np.ndarray:
        return prefix(self.hash)


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``size`` values that stay inside one row, and
    the number of them in each row.  ``first``: offsets of the rows."""
    n = np.maximum(np.diff(first) - size + 1, 0)
    total = int(n.sum())
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
    return at, n


_AT = 24  # low bits that hold a place within a block


def leftmost_min(h: np.ndarray, w: int) -> np.ndarray:
    """For each i the place of the smallest of h[i:i+w] by its upper 40 bits,
    the leftmost of equal ones; for i up to len(h) - w."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out, block = np.empty(n, np.int64), (1 << _AT) - w
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        v = h[lo:hi + w - 1]
        m = (v >> U(_AT) << U(_AT)) | np.arange(len(v), dtype=np.uint64)
        reach = 1
        while reach * 2 <= w:
            m = np.minimum(m[:-reach], m[reach:])
            reach *= 2
        if reach < w:
            m = np.minimum(m[:hi - lo], m[w - reach:w - reach + hi - lo])
        out[lo:hi] = (m[:hi - lo] & U((1 << _AT) - 1)).astype(np.int64) + lo
    return out


def join_runs(at: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each maximal run; ``same[i]`` tells whether
    element i + 1 goes on with element i.  ``at`` gives the length only."""
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(~same)
    return np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
