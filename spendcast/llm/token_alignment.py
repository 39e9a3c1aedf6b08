"""Alignment of two tokenizers over a corpus: which tokens of one go with which of the other.

1. Rows with equal texts are grouped by a shuffle on the whole text; every distinct
   text is tokenised and aligned once and stands for its number of documents.
2. Byte offsets where tokens of both end cut a text into groups; within a group every
   A token is linked with every B token.  Texts are gathered in blocks of some megabytes;
   a block keeps the distinct id pairs of each of its texts and, for the counts, the sum
   of their documents by pair, so what is shuffled is one row per pair and block.
3. The counts of pairs, and for each A id the highest, go back to the blocks that hold
   the pair; a block's table is as large as its own pairs.  Each text's measures follow,
   and are joined to the doc_ids by the text's SHA-256.

Tokens come from the two libraries, text by text; offsets, groups, links and the written
groups are then array operations over some hundred texts at a time.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_text, pin

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK = 4 << 20  # bytes of text in a block; bounds a worker's memory, not its results
_SLICE, _RANGE = 1 << 18, 1 << 17  # characters aligned, and tokens written out, at once; bound memory only
_WIDE = 4096  # links of a group from which they are counted by id
_ROWS = 256  # texts turned into Python objects at once
_RARE = re.compile("[^\x00-\u024f]")
_SPACE = "▁"


def _byte_of() -> dict[str, int]:
    """The characters by which a byte-level vocabulary writes bytes: printable ones of
    Latin-1 stand for themselves, the others for 256, 257 and so on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class _Spelling:
    """Byte strings by number, laid out so that many are written by one lookup."""

    def __init__(self, strings: list[bytes]):
        self.flat = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def write(self, numbers: np.ndarray) -> np.ndarray:
        size = self.size[numbers]
        before = np.cumsum(size) - size
        return self.flat[np.repeat(self.start[numbers] - before, size) + np.arange(int(size.sum()))]


class Aligned:
    """What ``Aligner`` finds in a text: n_a, n_b, n_groups, n_links, the SHA-256 of its
    groups written out (and these, if asked for), the codes (a * size of B + b) of its
    linked pairs in order, and how often each is linked."""

    __slots__ = ("sizes", "digest", "written", "codes", "times")


class Aligner:
    """Two tokenizers by their files: A a byte-level BPE, B a SentencePiece model."""

    def __init__(self, path_a: str, path_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _byte_of()
        ids = {bytes(byte[c] for c in t): i for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)}
        bytes_a = [b""] * (1 + max(ids.values()))
        for t, i in ids.items():
            bytes_a[i] = t
        # the same merges through a faster library, for characters that all versions of Unicode class alike
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                      mergeable_ranks={t: i for t, i in ids.items() if t and t != b"<|endoftext|>"}).encode_ordinary
        self.many_b = self.b.get_piece_size()
        bytes_b = []
        for i in range(self.many_b):
            piece = self.b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else
                           b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace(_SPACE, " ").encode())
        self.spell_a, self.spell_b = _Spelling(bytes_a), _Spelling(bytes_b)
        #: Ids as written among the groups, by 2 * id + (last of its group); B's after A's.
        self.numbers = _Spelling([f"{i}{end}".encode() for n, ends in ((len(bytes_a), ",|"), (self.many_b, ",;")) for i in range(n) for end in ends])
        self.from_b = 2 * len(bytes_a)

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        a = self.a.encode(" " + text, add_special_tokens=False).ids if _RARE.search(text) else self.fast(" " + text)
        return np.array(a, np.int64), np.array(self.b.encode(text), np.int64)

    def __call__(self, texts: list[str], write: bool = False) -> list[Aligned | None]:
        """Of each text, or None for those without tokens."""
        out: list[Aligned | None] = [None] * len(texts)
        found = []
        for k, text in enumerate(texts):
            if text:
                a, b = self.ids(text)
                raw = np.frombuffer((" " + text).encode(), np.uint8)
                if np.array_equal(self.spell_a.write(a), raw) and np.array_equal(self.spell_b.write(b), raw):
                    found.append((k, a, b))
        if not found:
            return out
        a, b = (np.concatenate([f[i] for f in found]) for i in (1, 2))
        end_a, end_b = np.cumsum(self.spell_a.size[a]), np.cumsum(self.spell_b.size[b])
        # groups: where tokens of both end, as every text does
        last_a = np.flatnonzero(end_b[np.searchsorted(end_b, end_a)] == end_a)
        last_b = np.flatnonzero(end_a[np.searchsorted(end_a, end_b)] == end_b)
        first_a, first_b = (np.concatenate([[0], x[:-1] + 1]) for x in (last_a, last_b))
        many_a, many_b = last_a - first_a + 1, last_b - first_b + 1
        upto = np.cumsum([len(f[1]) for f in found])  # tokens of A, by text
        text_of = np.searchsorted(upto, last_a, "right")
        n_groups = np.bincount(text_of, minlength=len(found))
        n_links = np.add.reduceat(many_a * many_b, np.cumsum(n_groups) - n_groups)
        hashes, written = [hashlib.sha256() for _ in found], [[] for _ in found]
        keys, times = [], []
        edges = np.searchsorted(np.cumsum(many_a + many_b), np.arange(_RANGE, len(a) + len(b), _RANGE))
        for lo, hi in zip([0, *edges], [*edges, len(last_a)]):
            if lo == hi:
                continue
            some = slice(lo, hi)
            of_a, of_b = (np.repeat(np.arange(lo, hi), x[some]) for x in (many_a, many_b))
            ids_a, ids_b = a[first_a[lo]:last_a[hi - 1] + 1], b[first_b[lo]:last_b[hi - 1] + 1]
            # in writing, B's tokens of a group follow A's
            row = np.empty(len(ids_a) + len(ids_b), np.int64)
            place_a = np.arange(len(ids_a)) + first_b[of_a] - first_b[lo]
            place_b = np.arange(len(ids_b)) + last_a[of_b] + 1 - first_a[lo]
            row[place_a] = 2 * ids_a
            row[place_b] = self.from_b + 2 * ids_b
            row[place_a[last_a[some] - first_a[lo]]] += 1
            row[place_b[last_b[some] - first_b[lo]]] += 1
            line = self.numbers.write(row)
            end = np.cumsum(self.numbers.size[row])[place_b[last_b[some] - first_b[lo]]]  # of each group
            here = text_of[some]
            for t in range(here[0], here[-1] + 1):
                g0, g1 = np.searchsorted(here, t), np.searchsorted(here, t, "right")
                part = line[end[g0 - 1] if g0 else 0:end[g1 - 1]].tobytes()
                part = part[:-1] if g1 + lo == len(text_of) or text_of[g1 + lo] != t else part
                hashes[t].update(part)
                if write:
                    written[t].append(part)
            # links; a group of very many is counted by id instead
            wide = many_a[some] * many_b[some] > _WIDE
            each = np.where(wide, 0, many_b[some])[of_a - lo]
            left = np.repeat(np.arange(len(ids_a)), each)
            right = np.repeat(first_b[of_a] - first_b[lo] - (np.cumsum(each) - each), each) + np.arange(len(left))
            keys.append(text_of[of_a][left] << 32 | ids_a[left] * self.many_b + ids_b[right])
            times.append(np.ones(len(left), np.int64))
            for g in np.flatnonzero(wide) + lo:
                (x, n), (y, m) = (np.unique(v[f[g]:e[g] + 1], return_counts=True) for v, f, e in ((a, first_a, last_a), (b, first_b, last_b)))
                keys.append((text_of[g] << 32 | x[:, None] * self.many_b + y[None, :]).ravel())
                times.append((n[:, None] * m[None, :]).ravel())
        keys, times = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, times = keys[first], np.add.reduceat(times[order], first)
        cut = np.searchsorted(keys >> 32, np.arange(len(found) + 1))
        for t, (k, ids_a, ids_b) in enumerate(found):
            x = out[k] = Aligned()
            x.sizes = (len(ids_a), len(ids_b), int(n_groups[t]), int(n_links[t]))
            x.digest, x.written = hashes[t].digest(), b"".join(written[t])
            x.codes, x.times = keys[cut[t]:cut[t + 1]] & 0xFFFFFFFF, times[cut[t]:cut[t + 1]]
        return out


def _slices(texts: list[str]):
    """Runs of texts of about ``_SLICE`` characters, or of one longer text."""
    lo = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= _SLICE:
            yield lo, k + 1
            lo, size = k + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _path(model: str) -> str:
    if "/" in model:
        return model
    import public_tokenizers
    return public_tokenizers.path(model)


def aligner(model_a: str = MODEL_A, model_b: str = MODEL_B) -> Aligner:
    """One for the life of a Python worker; a model is a path or a public vocabulary's name."""
    key = model_a, model_b
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(_path(model_a), _path(model_b))
    return _ALIGNERS[key]


def alignments(docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """doc_id and ``groups`` of every row, written ``a1,a2|b1;a3|b2,b3``; empty for texts
    without tokens (see ``measures``)."""
    def run(batches):
        align = aligner(model_a, model_b)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for lo, hi in _slices(texts):
                written = [x.written.decode() if x else "" for x in align(texts[lo:hi], write=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(written, pa.string())], names=["doc_id", "groups"])

    return id_text(docs).mapInArrow(run, "doc_id long, groups string")


_BLOCK = "block long, codes array<long>, weights array<long>, digests binary, sizes binary, pairs binary, at binary, times binary"


def _blocks(model_a: str, model_b: str):
    """Rows of ``_BLOCK`` out of (text, n): codes, in order, of all pairs in the block and
    how many documents hold them; of each text its SHA-256 and that of its groups, its
    four counts and its number of pairs; of each pair of a text its place in ``codes``
    and how often it is linked."""
    def run(batches):
        from pyspark import TaskContext
        align, block = aligner(model_a, model_b), TaskContext.get().partitionId() << 32
        texts: list[tuple] = []
        size = 0

        def flush():
            nonlocal block, size
            pairs = np.array([len(t[3]) for t in texts], np.int64)
            codes, at = np.unique(np.concatenate([t[3] for t in texts]), return_inverse=True)
            weights = np.zeros(len(codes), np.int64)
            np.add.at(weights, at, np.repeat(np.array([t[1] for t in texts], np.int64), pairs))
            row = pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([codes], pa.list_(pa.int64())), pa.array([weights], pa.list_(pa.int64())),
                 pa.array([b"".join(t[0] for t in texts)], pa.binary()), pa.array([np.array([t[2] for t in texts], "<i8").tobytes()], pa.binary()),
                 pa.array([pairs.astype("<u4").tobytes()], pa.binary()), pa.array([at.astype("<u4").tobytes()], pa.binary()),
                 pa.array([np.concatenate([t[4] for t in texts]).astype("<i8").tobytes()], pa.binary())],
                names=["block", "codes", "weights", "digests", "sizes", "pairs", "at", "times"])
            texts.clear()
            block, size = block + 1, 0
            return row

        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                some = batch.slice(lo, _ROWS)
                rows, copies = some.column("text").to_pylist(), some.column("n").to_pylist()
                for first, end in _slices(rows):
                    for text, n, x in zip(rows[first:end], copies[first:end], align(rows[first:end])):
                        if x:
                            texts.append((hashlib.sha256(text.encode()).digest() + x.digest, n, x.sizes, x.codes, x.times))
                            size += len(text)
                    if size >= BLOCK:
                        yield flush()
        if texts:
            yield flush()
    return run


def _found_pairs(blocks: DataFrame, many_b: int) -> DataFrame:
    """code and value: twice the number of documents, plus 1 if it is the A id's highest."""
    counts = (blocks.select(F.explode(F.arrays_zip("codes", "weights")).alias("p")).groupBy(F.col("p.codes").alias("code"))
              .agg(F.sum("p.weights").alias("documents")))
    # an A id has one row for each B id at most
    highest = F.max("documents").over(W.partitionBy(F.expr(f"code div {many_b}")))
    return counts.withColumn("best", F.col("documents") == highest)


def _aligned_blocks(docs: DataFrame, model_a: str, model_b: str) -> DataFrame:
    texts = id_text(docs).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    return pin(texts.mapInArrow(_blocks(model_a, model_b), _BLOCK), "zstd")


def pair_table(docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """a, b (ids linked somewhere), documents (rows that hold them linked), best (whether
    no other b has more for this a); edge cases as in ``measures``."""
    many_b = aligner(model_a, model_b).many_b
    return _found_pairs(_aligned_blocks(docs, model_a, model_b), many_b).select(
        F.expr(f"code div {many_b}").alias("a"), (F.col("code") % many_b).alias("b"), "documents", "best")


def _measured(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            codes = batch.column("codes")[r].values.to_numpy()
            answer = batch.column("answer")[r].values
            value = np.empty(len(codes), np.int64)
            value[np.searchsorted(codes, answer.field(0).to_numpy())] = answer.field(1).to_numpy()
            get = lambda c, kind: np.frombuffer(batch.column(c)[r].as_buffer(), kind)
            at, times, pairs = get("at", "<u4"), get("times", "<i8"), get("pairs", "<u4").astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(pairs)[:-1]])
            sizes, digests = get("sizes", "<i8").reshape(-1, 4), batch.column("digests")[r].as_py()
            n = len(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([digests[64 * k:64 * k + 32] for k in range(n)], pa.binary())]
                + [pa.array(sizes[:, k].copy()) for k in range(4)]
                + [pa.array(np.add.reduceat(times * (value[at] & 1), edges)), pa.array(np.add.reduceat(times * (value[at] >> 1), edges)),
                   pa.array([digests[64 * k + 32:64 * k + 64].hex() for k in range(n)], pa.string())],
                names=[c.split()[0] for c in _MEASURES.split(", ")])


_MEASURES = ("digest binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def measures(docs: DataFrame, model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256.

    A tokenises a space and the text, B the text (it adds the space itself).  Null and
    empty texts, and texts whose tokens' bytes are not that space and text, have no
    tokens: zeros and ''.  Every row counts as a document, also repeated ones and those
    without doc_id.  An empty table gives an empty result; other columns are not read."""
    blocks = _aligned_blocks(docs, model_a, model_b)
    pairs = pin(_found_pairs(blocks, aligner(model_a, model_b).many_b).select(
        "code", (2 * F.col("documents") + F.col("best").cast("long")).alias("value")))
    asked = blocks.select("block", F.explode("codes").alias("code"))
    answers = pin(asked.join(pairs, "code").groupBy("block").agg(F.collect_list(F.struct("code", "value")).alias("answer")), "zstd")
    found = pin(blocks.select("block", "codes", "digests", "sizes", "pairs", "at", "times").join(answers, "block")
                .drop("block").mapInArrow(_measured, _MEASURES), "zstd")
    rows = id_text(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"))
    zero = F.lit(0).cast("long")
    return rows.join(found, "digest", "left").select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
