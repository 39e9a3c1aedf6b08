"""SentencePiece (BPE) encoding with seeded merge-dropout, and decoding.

Merges come from an agenda, best score first, then leftmost; each candidate is
skipped by a hash keyed with seed, document and the places in the text where it
begins and ends, so a seed always gives the same segmentation, other seeds give
others, and a word that comes again is cut anew.  The agendas of many chunks
advance together: one step merges the head of every chunk's agenda, as array
operations over a block of chunks of like length, so no cache of words is needed
and memory is that of a block.  Long chunks have a heap each.  Every segmentation
decodes to the text.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text
from .textnum import U, mix

MODEL = "piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 1
_SPACE = "▁"
_MARK, _BLANK, _LINE = ord(_SPACE), ord(" "), ord("\n")
SLICE = 1 << 18  # characters of whole texts encoded at once
_CELLS = 1 << 16  # symbols of a block
_WIDTHS = (2, 4, 8, 16, 32, 64)  # of blocks; longer chunks take a heap
_NONE = np.int32(2**31 - 1)
_MASK = (1 << 64) - 1
_ODDS_BITS = 16  # of the dropout, as a binary fraction
_LO, _HI = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # keys of a candidate's first place and of its end


class Table:
    """Numbers of pairs of symbols, as an open-addressing table in arrays."""

    def __init__(self, pairs: dict[int, int]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.last = U(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, _MASK, np.uint64), np.full(1 << bits, -1, np.int32)
        keys, values = np.fromiter(pairs.keys(), np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == U(_MASK)
            _, at = np.unique(np.where(free, slot, -1), return_index=True)  # one key for each free slot
            at = at[free[at]]
            self.keys[slot[at]], self.values[slot[at]] = keys[at], values[at]
            left = np.ones(len(keys), bool)
            left[at] = False
            keys, values, slot = keys[left], values[left], slot[left]
            slot = np.where(self.keys[slot] == U(_MASK), slot, slot + 1 & self.last)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * U(_LO) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of ``keys`` (uint64); -1 for others."""
        slot = self._slot(keys)
        have = self.keys[slot]
        out = np.where(have == keys, self.values[slot], np.int32(-1))
        on = np.flatnonzero((have != keys) & (have != U(_MASK)))
        while len(on):
            slot[on] = slot[on] + 1 & self.last
            have = self.keys[slot[on]]
            hit = have == keys[on]
            out[on[hit]] = self.values[slot[on[hit]]]
            on = on[~hit & (have != U(_MASK))]
        return out


class Pieces:
    """Vocabulary of a model file: its merges by score, and ids to bytes.

    Symbols are ids of the model; characters inside pieces that are no piece
    themselves get numbers after them, and ``other`` stands for all the rest."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.merges, self.byte, self.bytes = sp.get_piece_size(), {}, np.zeros(256, np.uint32), []
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[1:-1], 16)
                self.byte[b] = i
                self.bytes.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes.append(b"")
            else:
                self.merges[piece] = (-sp.get_score(i), i)
                self.bytes.append(piece.replace(_SPACE, " ").encode())
        self.longest = max(map(len, self.merges), default=0)
        symbols = {p: i for p, (_, i) in self.merges.items()}
        for c in sorted({c for p in self.merges for c in p} - symbols.keys()):
            symbols[c] = self.size + len(symbols) - len(self.merges)
        self.other = self.size + len(symbols) - len(self.merges)
        self.many = U(self.other + 1)
        self.of_char = np.full(0x110000, self.other, np.int32)
        self.rank = np.zeros(self.size, np.int32)
        ids = [i for _, i in self.merges.values()]
        self.rank[ids] = np.unique([cost for cost, _ in self.merges.values()], return_inverse=True)[1]
        pairs, inside = {}, {}
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        for p, (_, whole) in self.merges.items():
            for k in range(1, len(p)):
                inside[symbols[p[k - 1]] * int(self.many) + symbols[p[k]]] = 1
                if (a := symbols.get(p[:k])) is not None and (b := symbols.get(p[k:])) is not None:
                    pairs[a * int(self.many) + b] = whole
        #: What two symbols merge to; neighbouring characters of all pieces, for no merge reaches across others.
        self.pairs, self.inside = Table(pairs), Table(inside)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(self.bytes), np.uint8)

    def keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) * self.many + right.astype(np.uint64)

    def decoded(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of ids; the space put before a text is taken off."""
        n = self.lengths[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        data = self.blob[at].tobytes()
        return data[1:] if data[:1] == b" " else data

    def decode(self, ids) -> str:
        return self.decoded(np.asarray(ids, np.int64)).decode()


def _mix(h: int) -> int:
    """``textnum.mix`` of one number."""
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= h >> 33
        h = h * factor & _MASK
    return h ^ h >> 33


class Encoder:
    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        self.pieces, self.seed = Pieces(path), seed
        self.odds = round(dropout * (1 << _ODDS_BITS))

    def stream_of(self, doc_id) -> int:
        """Every document has a stream of its own: 64 bits of a keyed hash of its id."""
        return int.from_bytes(hashlib.blake2b(f"{self.seed} {doc_id}".encode(), digest_size=8).digest(), "little")

    def skips(self, stream: int, lo: int, hi: int) -> bool:
        """Whether the candidate that covers the places lo to hi of a text is skipped."""
        return _mix(stream + lo * _LO + hi * _HI & _MASK) >> 64 - _ODDS_BITS < self.odds

    def _taken(self, base: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """``skips``, denied, for arrays; places count from those in ``base``."""
        h = mix(base + lo.astype(np.uint64) * U(_LO) + hi.astype(np.uint64) * U(_HI))
        return (h >> U(64 - _ODDS_BITS)).astype(np.int64) >= self.odds

    def _block(self, symbols: np.ndarray, ends: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Runs the agendas of the rows of ``symbols`` (one column more than the
        longest chunk, ``other`` behind each) in place; returns which are gone."""
        rows, width = symbols.shape
        sym, pieces = symbols.reshape(-1), self.pieces
        after = np.tile(np.arange(1, width + 1), (rows, 1)).reshape(-1)
        before = after - 2
        cost, whole = np.full((rows, width), _NONE), np.zeros(rows * width, np.int32)
        flat, gone = cost.reshape(-1), np.zeros(rows * width, bool)

        def offer(at, right, row, lo, hi):
            merged = pieces.pairs.get(pieces.keys(sym[at], sym[right]))
            f = np.flatnonzero(merged >= 0)
            f = f[self._taken(base[row[f]], lo[f], hi[f])]
            flat[at[f]], whole[at[f]] = pieces.rank[merged[f]], merged[f]

        at = np.flatnonzero((np.arange(width) < ends[:, None] - 1).reshape(-1))
        offer(at, at + 1, at // width, at % width, at % width + 2)
        live = np.arange(rows)
        while len(live):
            sub = cost[live]
            i = sub.argmin(1)
            on = sub[np.arange(len(live)), i] < _NONE
            if not on.all():
                live, i = live[on], i[on]
            row = live * width
            p = row + i
            q = row + after[p]
            k = after[q]
            e = row + k
            sym[p], after[p], before[e], gone[q] = whole[p], k, i, True
            flat[p] = flat[q] = _NONE
            has = np.flatnonzero(before[p] >= 0)
            left = before[p[has]]
            flat[row[has] + left] = _NONE
            offer(np.concatenate([p, row[has] + left]), np.concatenate([e, p[has]]), np.concatenate([live, live[has]]),
                  np.concatenate([i, left]), np.concatenate([after[e], k[has]]))
        return gone.reshape(rows, width)

    def _long(self, chunk: str, stream: int, lo: int) -> list[tuple[int, int]]:
        """Place and id of the merged symbols of one long chunk, and (place, -1) of
        those that a merge took in; the agenda as a heap."""
        n, get, most = len(chunk), self.pieces.merges.get, self.pieces.longest
        before, after, whole, agenda = list(range(-1, n)), list(range(1, n + 2)), {}, []

        def offer(i):
            j = after[i]
            if j < n and after[j] - i <= most and (m := get(chunk[i:after[j]])) and not self.skips(stream, lo + i, lo + after[j]):
                heapq.heappush(agenda, (m[0], i, j, after[j], m[1]))

        for i in range(n - 1):
            offer(i)
        while agenda:
            _, i, j, k, merged = heapq.heappop(agenda)
            if whole.get(i) == -1 or whole.get(j) == -1 or after[i] != j or after[j] != k:
                continue
            whole[i], whole[j], after[i] = merged, -1, k
            if k < n:
                before[k] = i
                offer(i)
            if before[i] >= 0:
                offer(before[i])
        return list(whole.items())

    def __call__(self, texts: list[str], doc_ids: list) -> list[np.ndarray]:
        """Ids of every text."""
        full = [t for t in texts if t]
        if not full:
            return [np.zeros(0, np.int64) for _ in texts]
        pieces = self.pieces
        joined = "".join([" " + t for t in full])
        char = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        first = np.cumsum([0] + [len(t) + 1 for t in full])
        stream = np.array([self.stream_of(d) for t, d in zip(texts, doc_ids) if t], np.uint64)
        mark, blank, line = char == _MARK, char == _BLANK, char == _LINE
        sym = pieces.of_char[np.where(blank, _MARK, char)]
        sym[mark] = pieces.other  # a mark in the text itself goes by its bytes
        cut = np.ones(len(char) + 1, bool)
        cut[1:-1] = line[1:] | line[:-1] | blank[1:] & ~blank[:-1] | (pieces.inside.get(pieces.keys(sym[:-1], sym[1:])) < 0)
        cut[first] = True
        start = np.flatnonzero(cut)
        start, n = start[:-1], np.diff(start)
        gone = np.zeros(len(char), bool)
        doc = np.searchsorted(first, start, "right") - 1
        place = start - first[doc]
        base = stream[doc] + place.astype(np.uint64) * U(_LO + _HI & _MASK)
        least = 1
        for w in _WIDTHS:
            of_width = np.flatnonzero((n > least) & (n <= w))
            least, step = w, max(1, _CELLS // (w + 1))
            for b in range(0, len(of_width), step):
                c = of_width[b:b + step]
                at, filled = start[c][:, None] + np.arange(w + 1), np.arange(w + 1) < n[c][:, None]
                block = np.where(filled, sym[np.minimum(at, len(sym) - 1)], np.int32(pieces.other))
                out = self._block(block, n[c], base[c])
                at = at[filled]
                sym[at], gone[at] = block[filled], out[filled]
        for c in np.flatnonzero(n > least).tolist():
            lo = int(start[c])
            for i, merged in self._long(joined[lo:lo + int(n[c])].replace(" ", _SPACE), int(stream[doc[c]]), int(place[c])):
                if merged < 0:
                    gone[lo + i] = True
                else:
                    sym[lo + i] = merged
        at = np.flatnonzero(~gone)
        left = sym[at]
        raw = left >= pieces.size  # characters that go by their bytes
        spelt = np.where(blank[at[raw]], _MARK, char[at[raw]]).astype("<u4")
        many = np.ones(len(at) + 1, np.int64)
        many[:-1][raw] = 1 + (spelt >= 0x80) + (spelt >= 0x800) + (spelt >= 0x10000)
        to = np.cumsum(many) - many
        ids = np.empty(to[-1], np.int64)
        ids[to[:-1][~raw]] = left[~raw]
        if raw.any():
            k = many[:-1][raw]
            ids[np.repeat(to[:-1][raw] - (np.cumsum(k) - k), k) + np.arange(k.sum())] = pieces.byte[
                np.frombuffer(spelt.tobytes().decode("utf-32-le").encode(), np.uint8)]
        parts = iter(np.split(ids, to[np.searchsorted(at, first[1:-1])]))
        return [next(parts) if t else np.zeros(0, np.int64) for t in texts]

    def slices(self, texts: list[str], doc_ids: list):
        """Ids of every text in turn, slice by slice of whole texts."""
        lo = size = 0
        for hi, t in enumerate(texts, 1):
            size += len(t)
            if size >= SLICE or hi == len(texts):
                yield from self(texts[lo:hi], doc_ids[lo:hi])
                lo, size = hi, 0


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> Encoder:
    """One encoder for the life of a Python worker; ``model``: a path, or the
    name of one of the public vocabularies."""
    key = (model, dropout, seed)
    if key not in _ENCODERS:
        path = model
        if "/" not in model:
            import public_tokenizers
            path = public_tokenizers.path(model)
        _ENCODERS[key] = Encoder(path, dropout, seed)
    return _ENCODERS[key]


def encode(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, model: str = MODEL) -> DataFrame:
    """doc_id and ``ids``; null and empty texts have none, repeated rows get the
    same, an empty table gives an empty result."""
    def run(batches):
        enc = encoder(model, dropout, seed)
        for batch in batches:
            ids = [i.astype(np.int32) for i in enc.slices(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the ``text`` of ``ids``; null ids give null."""
    def run(batches):
        pieces = encoder(model).pieces
        for batch in batches:
            text = [None if i is None else pieces.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, stream (31 bits of it), n_ids, ids_crc32 (unsigned, of the
    little-endian unsigned 32-bit ids), decoded_sha256 and whether the ids decode
    to the text."""
    def run(batches):
        enc = encoder(model, dropout, seed)
        for batch in batches:
            out, doc_ids, texts = [], batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for d, t, ids in zip(doc_ids, texts, enc.slices(texts, doc_ids)):
                back = enc.pieces.decoded(ids)
                out.append((enc.stream_of(d) >> 33, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                            hashlib.sha256(back).hexdigest(), back == t.encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array([o[k] for o in out], t) for k, t in enumerate(
                    (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
                names=["doc_id", "stream", "n_ids", "ids_crc32", "decoded_sha256", "lossless"])

    return id_text(docs).mapInArrow(
        run, "doc_id long, stream int, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean")
