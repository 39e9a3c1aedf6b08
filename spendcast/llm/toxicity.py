"""Toxicity by nearest labelled examples: exact TF-IDF cosine over an inverted
index with block maxima.

A bounded, balanced sample of labelled rows (SAMPLE) gives the examples, and all
their terms are indexed; inverse document frequencies count all documents, and
terms whose use differs significantly between the classes weigh more.  Examples
lie in blocks; a block's per-term maxima bound the cosine of its members, so only
blocks that may hold a nearer example are read.  Votes weighted by cosine are
calibrated on the examples themselves, each left out of its own vote.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_text
from .textnum import Words, text_slices

#: Examples of each class at most, the first by hash of doc_id; terms that weigh
#: more at most, and how much more; neighbours that vote; examples of a block;
#: neighbours given as evidence.
SAMPLE = 3000
TERMS = 256
TELLING = 4.0
NEIGHBOURS = 25
BLOCK = 32
EVIDENCE = 3
LEAST_SCORE = 0.5
#: Weight, in squared cosines, of the labelled rows' share in a vote.
FAR = 0.05
#: Least G statistic (chi-square, one degree of freedom) and documents of a term.
_LEAST_G, _LEAST_DOCS = 24.0, 4
_CACHE_MOST = 20_000
_FIRST, _FEW = 2, 8  # blocks read at first; blocks beyond which all postings are added up

_BREAK = np.ones(256, bool)
_BREAK[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _terms(buf, off):
    """Distinct terms of every row: hash, count, row edges."""
    w = Words(buf, off, lower=True, space=_BREAK)
    order = np.lexsort((w.hash, w.row))
    h, row = w.hash[order].view(np.int64), w.row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    return h[begin], np.diff(np.concatenate([begin, [len(h)]])), np.searchsorted(row[begin], np.arange(len(off)))


def _extract(batches):
    for batch in batches:
        for lo, hi, buf, off in text_slices(batch.column("text")):
            h, n, edges = _terms(buf, off)
            out = [(h[a:b].tobytes(), n[a:b].astype(np.int32).tobytes()) for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo),
                 pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.binary())],
                names=["doc_id", "label", "h", "n"])


def _document_frequencies(vocabulary: np.ndarray):
    def run(batches):
        total, df = 0, np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column("text")):
                h, _, _ = _terms(buf, off)
                at, hit = _find(vocabulary, h)
                df += np.bincount(at[hit], minlength=len(vocabulary))
                total += hi - lo
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], at])), pa.array(np.concatenate([[total], df[at]]))],
                                         names=["term", "df"])
    return run


def _find(vocabulary: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes in the sorted vocabulary, and which are there."""
    at = np.searchsorted(vocabulary, h)
    hit = at < len(vocabulary)
    hit[hit] = vocabulary[at[hit]] == h[hit]
    return at, hit


def _select(rows, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, of all terms, and which tell the classes apart best."""
    h = np.concatenate([np.frombuffer(r.h, np.int64) for r in rows] or [np.zeros(0, np.int64)])
    y = np.repeat([r.label for r in rows], [len(r.h) // 8 for r in rows]).astype(int)
    terms, at = np.unique(h, return_inverse=True)
    pos, n = np.bincount(at, y, len(terms)), np.bincount(at, minlength=len(terms)).astype(float)
    big_n, big_p = float(max(1, len(rows))), float(sum(r.label for r in rows))
    g = np.zeros(len(terms))
    for k, e in ((pos, n * big_p / big_n), (n - pos, n * (1 - big_p / big_n)), (big_p - pos, (big_n - n) * big_p / big_n),
                 (big_n - big_p - n + pos, (big_n - n) * (1 - big_p / big_n))):
        g += 2 * k * np.log(np.maximum(k, 1e-9) / np.maximum(e, 1e-9))
    good = np.flatnonzero((g >= _LEAST_G) & (n >= _LEAST_DOCS))
    good = good[np.lexsort((terms[good], -g[good]))][:most]
    telling = np.zeros(len(terms), bool)
    telling[good] = True
    return terms, telling


class Sparse:
    """Rows of (column, value), columns ascending."""

    def __init__(self, edges: np.ndarray, cols: np.ndarray, values: np.ndarray, width: int):
        self.edges, self.cols, self.values, self.width = edges, cols.astype(np.int32), values, width
        self.row = np.repeat(np.arange(len(edges) - 1, dtype=np.int32), np.diff(edges))

    @classmethod
    def of(cls, dense: np.ndarray) -> "Sparse":
        row, cols = np.nonzero(dense)
        return cls(np.searchsorted(row, np.arange(len(dense) + 1)), cols, dense[row, cols], dense.shape[1])

    def __len__(self) -> int:
        return len(self.edges) - 1

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * q[self.cols], len(self))

    def take(self, order: np.ndarray) -> "Sparse":
        k = _ranges(self.edges[order], self.edges[order + 1])
        edges = np.concatenate([[0], np.cumsum(np.diff(self.edges)[order])])
        return Sparse(edges, self.cols[k], self.values[k], self.width)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of lo[0]:hi[0], lo[1]:hi[1] and so on."""
    n = hi - lo
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


class Index:
    """Unit vectors of the examples (docs x terms; an array or ``Sparse``), in
    blocks of like ones."""

    def __init__(self, vectors, label: np.ndarray, doc_id: np.ndarray):
        v = vectors if isinstance(vectors, Sparse) else Sparse.of(vectors)
        by_value = np.lexsort((v.cols, -v.values, v.row))
        top, has = by_value[np.minimum(v.edges[:-1], max(len(by_value) - 1, 0))] if len(by_value) else None, np.diff(v.edges) > 0
        chief = np.where(has, v.cols[top], -1) if top is not None else np.full(len(v), -1)
        weight = np.where(has, v.values[top], 0.0) if top is not None else np.zeros(len(v))
        order = np.lexsort((doc_id, weight, chief))
        self.vectors, self.label, self.doc_id = v.take(order), label[order], doc_id[order]
        self.first = np.append(np.arange(0, len(order), BLOCK), len(order))  # and the end
        v = self.vectors
        by_term = np.lexsort((v.row, v.cols))
        cols = v.cols[by_term]
        self.docs, self.weights = v.row[by_term], v.values[by_term]  # postings of the terms
        self.edges = np.searchsorted(cols, np.arange(v.width + 1))
        block = self.docs // BLOCK
        begin = np.flatnonzero(np.concatenate([[True], (cols[1:] != cols[:-1]) | (block[1:] != block[:-1])])[:len(cols)])
        self.blocks = block[begin]  # blocks that hold a term, and the most it has there
        self.most = np.maximum.reduceat(self.weights, begin) if len(begin) else np.zeros(0)
        self.block_edges = np.searchsorted(cols[begin], np.arange(v.width + 1))
        self._query = np.zeros(v.width)

    def _sum(self, edges, at, weight, terms, values, n):
        k = _ranges(edges[terms], edges[terms + 1])
        return np.bincount(at[k], weight[k] * np.repeat(values, edges[terms + 1] - edges[terms]), n)

    def _cosines(self, blocks):
        """Members of the blocks and their cosines with the query."""
        v = self.vectors
        i = _ranges(self.first[blocks], self.first[blocks + 1])
        lo, hi = v.edges[i], v.edges[i + 1]
        k = _ranges(lo, hi)
        return i, np.bincount(np.repeat(np.arange(len(i)), hi - lo), v.values[k] * self._query[v.cols[k]], len(i))

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int, without: int = -1):
        """Exact top k by (cosine, index) of a sparse unit vector: indexes and
        cosines above 0.  ``terms`` ascend."""
        bound = self._sum(self.block_edges, self.blocks, self.most, terms, values, len(self.first) - 1)
        blocks = np.argsort(-bound, kind="stable")
        blocks = blocks[bound[blocks] > 0]
        self._query[terms] = values
        ids, cos = np.zeros(0, np.int64), np.zeros(0)
        while len(blocks):
            if len(blocks) > _FEW and len(cos):
                i, c = np.arange(len(self.label)), self._sum(self.edges, self.docs, self.weights, terms, values, len(self.label))
                ids, cos, blocks = ids[:0], cos[:0], blocks[:0]
            else:
                i, c = self._cosines(blocks[:_FIRST])
                blocks = blocks[_FIRST:]
            use = np.flatnonzero((c > 0) & (i != without))
            ids, cos = np.concatenate([ids, i[use]]), np.concatenate([cos, c[use]])
            if len(cos) > k:
                use = cos >= np.partition(cos, -k)[-k]
                ids, cos = ids[use], cos[use]
            best = np.lexsort((ids, -cos))[:k]
            ids, cos = ids[best], cos[best]
            if len(cos) >= k:
                blocks = blocks[bound[blocks] >= cos[-1] - 1e-12]
        self._query[terms] = 0
        return ids, cos


def _vectors(rows, vocabulary, weight) -> Sparse:
    cols, values = [np.zeros(0, np.int64)], [np.zeros(0)]
    for r in rows:
        at, hit = _find(vocabulary, np.frombuffer(r.h, np.int64))
        at, n = at[hit], np.frombuffer(r.n, np.int32)[hit]
        order = np.argsort(at)
        x = _unit(at[order], n[order], weight)
        cols.append(at[order])
        values.append(x)
    edges = np.cumsum([len(c) for c in cols])
    return Sparse(edges, np.concatenate(cols), np.concatenate(values), len(vocabulary))


def _unit(at: np.ndarray, n: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = (1 + np.log(n)) * weight[at]
    return x / np.sqrt((x * x).sum()) if len(x) else x


def _vote(index: Index, ids, cos, weight, prior: float) -> float:
    """Weighted share of toxic neighbours; closer ones count for more, and where
    all are far the share of all labelled rows holds."""
    w = cos * cos * weight[index.label[ids]]
    return float(((w * index.label[ids]).sum() + FAR * prior) / (w.sum() + FAR))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS) -> dict:
    """Vocabulary, index and calibration.  Rows of the held-out fold and null
    labels or ids are not learned from."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    first = lambda c: known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = first(1).unionByName(first(0))
    share = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    rows = (id_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
            .mapInArrow(_extract, "doc_id long, label int, h binary, n binary").collect())
    rows.sort(key=lambda r: (r.doc_id, r.label, bytes(r.h), bytes(r.n)))
    vocabulary, telling = _select(rows, terms)
    counts = (id_text(docs).select("text").mapInArrow(_document_frequencies(vocabulary), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).toArrow())  # one row a term
    df = np.zeros(len(vocabulary) + 1)
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()  # the last: all documents
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * np.where(telling, TELLING, 1.0)
    label = np.array([r.label for r in rows], int)
    index = Index(_vectors(rows, vocabulary, idf), label, np.array([r.doc_id for r in rows], np.int64))
    # a class that was sampled more thinly counts for more
    have = np.bincount(label, minlength=2)
    weight = np.array([share.get(c, 0) / max(1, have[c]) for c in (0, 1)], float)
    weight = weight / max(weight.max(), 1e-9)
    prior = share.get(1, 0) / sum(share.values()) if share else 0.5
    votes, w, y, zero = [], [], [], [0.0, 0.0]
    vectors = index.vectors
    for i in range(len(index.label)):
        at = slice(vectors.edges[i], vectors.edges[i + 1])
        c = int(index.label[i])
        ids, cos = index.nearest(vectors.cols[at], vectors.values[at], NEIGHBOURS, i)
        if not len(ids):
            zero[c] += weight[c]
            continue
        votes.append(_vote(index, ids, cos, weight, prior))
        w.append(weight[c])
        y.append(c)
    return {"vocabulary": vocabulary, "idf": idf, "index": index, "weight": weight,
            "steps": _monotone(np.array(votes), np.array(y, float), np.array(w)),
            "prior": prior,
            # without a neighbour: the share of such examples, smoothed towards that of all labelled rows
            "none": (zero[1] + prior) / (sum(zero) + 1.0)}


def _monotone(vote, label, weight):
    """Isotonic calibration by pooling neighbours that are out of order; each
    pool is smoothed by one example of either class, and votes between pools are
    interpolated."""
    order = np.argsort(vote, kind="stable")
    pools = []  # first vote, last vote, toxic weight, weight
    for v, y, w in zip(vote[order], label[order], weight[order]):
        pools.append([v, v, w * y, w])
        while len(pools) > 1 and (pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3] or pools[-2][1] == pools[-1][0]):
            b = pools.pop()
            pools[-1] = [pools[-1][0], b[1], pools[-1][2] + b[2], pools[-1][3] + b[3]]
    value = [(p[2] + 0.25) / (p[3] + 0.5) for p in pools]
    return np.array([v for p in pools for v in p[:2]]), np.repeat(value, 2)


def _scorer(model: dict):
    vocabulary, idf, index, cache = model["vocabulary"], model["idf"], model["index"], {}
    top, value = model["steps"]

    def one(at, n):
        order = np.argsort(at)
        ids, cos = index.nearest(at[order], _unit(at[order], n[order], idf), NEIGHBOURS)
        if not len(ids):
            return model["none"], []
        vote = _vote(index, ids, cos, model["weight"], model["prior"])
        score = float(np.interp(vote, top, value)) if len(value) else model["none"]
        near = [{"doc_id": int(index.doc_id[i]), "toxic": int(index.label[i]), "cosine": float(c)}
                for i, c in zip(ids[:EVIDENCE], cos[:EVIDENCE])]
        return score, near

    def run(batches):
        for batch in batches:
            score, near = [], []
            for lo, hi, buf, off in text_slices(batch.column("text")):
                h, n, edges = _terms(buf, off)
                at, hit = _find(vocabulary, h)
                at, n = at[hit], n[hit]
                edges = np.concatenate([[0], np.cumsum(hit)])[edges]
                for a, b in zip(edges.tolist(), edges[1:].tolist()):
                    key = hashlib.blake2b(at[a:b].tobytes() + n[a:b].tobytes(), digest_size=16).digest()
                    if key not in cache:
                        if len(cache) >= _CACHE_MOST:
                            cache.clear()
                        cache[key] = one(at[a:b], n[a:b]) if b > a else (model["none"], [])
                    score.append(cache[key][0])
                    near.append(cache[key][1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64()),
                 pa.array(near, pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())])))],
                names=["doc_id", "score", "evidence"])
    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence (the
    nearest examples with label and cosine).

    Texts without a term of any example, null and empty ones among them, get the
    toxic share of examples without a neighbour, smoothed; repeated rows score alike; an empty table
    gives an empty result."""
    out = id_text(docs).mapInArrow(
        _scorer(model), "doc_id long, score double, evidence array<struct<doc_id:long,toxic:int,cosine:double>>")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"), "evidence")
