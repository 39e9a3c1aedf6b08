"""Quality classifier: a linear-chain conditional random field over lines.

Every line gets features of its own and of its neighbours and a label, good or
bad; forward-backward marginals, weighted by line length and calibrated on the
training rows, give the document's score.  The field is fitted on the driver on
a bounded sample of labelled rows (SAMPLE); scoring covers every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, id_text
from .textnum import IS_SPACE, Words, bytes_prefix, span, text_slices

#: Labelled rows to learn from, the first by hash of doc_id.
SAMPLE = 4000
LEAST_SCORE = 0.3
_STEPS, _RATE, _L2 = 150, 0.1, 1e-3

_CLASSES = [np.zeros(256, bool) for _ in range(7)]
_CLASSES[0][65:91] = True
_CLASSES[1][48:58] = True
_CLASSES[2][[ord(c) for c in "#*$%&<>"]] = True
_CLASSES[3][ord("|")] = True
_CLASSES[4][ord("!")] = True
_CLASSES[5][[ord(c) for c in ".,;:?"]] = True
_CLASSES[6][128:] = True
_OWN = 13
FEATURES = 1 + 3 * _OWN


def line_features(buf: np.ndarray, off: np.ndarray):
    """Features of every line that has a word: (matrix, bytes of the line, row
    edges)."""
    n = len(buf)
    bounds = np.unique(np.concatenate([off, np.flatnonzero(buf == 10) + 1]))
    lo, hi = bounds[:-1], bounds[1:]
    full = np.concatenate([[0], np.cumsum(~IS_SPACE[buf])])
    some = full[hi] > full[lo]
    lo, hi = lo[some], hi[some]
    solid = (full[hi] - full[lo]).astype(float)
    edges = np.searchsorted(lo, off)
    row = np.repeat(np.arange(len(off) - 1), np.diff(edges))
    f = np.zeros((len(lo), _OWN))
    for k, table in enumerate(_CLASSES):
        c = np.concatenate([[0], np.cumsum(table[buf])])
        f[:, k] = np.minimum((c[hi] - c[lo]) / solid * 4, 2)
    w = Words(buf, off, lower=True)
    first, last = np.searchsorted(w.start, lo), np.searchsorted(w.start, hi)
    words = np.maximum(last - first, 1).astype(float)
    f[:, 7] = np.log1p(words) / 4
    f[:, 8] = np.minimum(solid / words / 8, 2)
    size = np.concatenate([[0], np.cumsum(w.end - w.start <= 3)])
    f[:, 9] = (size[last] - size[first]) / words
    # words and lines seen before in the document
    order = np.lexsort((np.arange(len(w.hash)), w.hash, w.row))
    again = np.zeros(len(w.hash), bool)
    if len(order):
        again[order[1:]] = (w.hash[order[1:]] == w.hash[order[:-1]]) & (w.row[order[1:]] == w.row[order[:-1]])
    seen = np.concatenate([[0], np.cumsum(again & (w.end - w.start > 6))])
    f[:, 10] = (seen[last] - seen[first]) / words * 2
    pre = bytes_prefix(buf)
    h = span(pre, lo, hi)
    order = np.lexsort((np.arange(len(h)), h, row))
    twin = np.zeros(len(h))
    if len(order):
        twin[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    f[:, 11] = twin
    f[:, 12] = np.minimum(np.log1p(solid) / 8, 2)
    x = np.zeros((len(lo), FEATURES))
    x[:, 0], x[:, 1:1 + _OWN] = 1, f
    same = row[1:] == row[:-1]
    x[1:, 1 + _OWN:1 + 2 * _OWN] = f[:-1] * same[:, None]
    x[:-1, 1 + 2 * _OWN:] = f[1:] * same[:, None]
    return x, (hi - lo).astype(float), edges


def _by_step(count: np.ndarray):
    """Documents in order of their lines, and how many reach each step."""
    order = np.argsort(-count, kind="stable")
    steps = int(count.max()) if len(count) else 0
    return order, np.searchsorted(-count[order], -np.arange(1, steps + 1), "right")


def marginals(emit: np.ndarray, trans: np.ndarray, edges: np.ndarray):
    """P(good) of each line, expected moves (bad/good x bad/good) and the log
    partition sum of all documents.  ``emit``: score of good less that of bad."""
    count = np.diff(edges)
    order, reach = _by_step(count)
    start, p = edges[:-1][order], np.exp(trans - trans.max())
    e = np.clip(emit, -30, 30)
    good, bad = 1 / (1 + np.exp(-e)), 1 / (1 + np.exp(e))
    fwd = np.empty((len(emit), 2))
    log_z = float(np.logaddexp(0, e).sum()) + float(trans.max()) * float(np.maximum(count - 1, 0).sum())
    for t, m in enumerate(reach):
        i = start[:m] + t
        a = np.ones((m, 2)) if t == 0 else fwd[i - 1] @ p
        a = a * np.stack([bad[i], good[i]], 1)
        s = a.sum(1, keepdims=True)
        log_z += float(np.log(s).sum())
        fwd[i] = a / s
    out, moves = np.empty(len(emit)), np.zeros((2, 2))
    beta = np.ones((len(count), 2))
    for t in range(len(reach) - 1, -1, -1):
        m = reach[t]
        i = start[:m] + t
        if t + 1 < len(reach):
            k = reach[t + 1]
            j = start[:k] + t + 1
            nxt = beta[:k] * np.stack([bad[j], good[j]], 1)
            pair = fwd[j - 1][:, :, None] * p[None] * nxt[:, None, :]
            moves += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
            b = nxt @ p.T
            beta[:k] = b / b.sum(1, keepdims=True)
        q = fwd[i] * beta[:m]
        out[i] = q[:, 1] / q.sum(1)
    return out, moves, log_z


def _document_scores(x, size, edges, weights, trans):
    """Length-weighted mean of the lines' P(good); nan where there is no line."""
    good, _, _ = marginals(x @ weights, trans, edges)
    total = np.concatenate([[0], np.cumsum(good * size)])
    length = np.concatenate([[0], np.cumsum(size)])
    with np.errstate(invalid="ignore"):
        return (total[edges[1:]] - total[edges[:-1]]) / (length[edges[1:]] - length[edges[:-1]])


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _platt(score, label, steps=300):
    a, b = 1.0, 0.0
    z = _logit(score)
    for _ in range(steps):  # Newton steps of a two-parameter logistic fit
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((p - label) * z).sum() + 1e-2 * (a - 1), (p - label).sum()])
        w = p * (1 - p) + 1e-6
        hess = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step = np.linalg.solve(hess, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(a, 0.05)), float(b)


def fit(x: np.ndarray, size: np.ndarray, edges: np.ndarray, label: np.ndarray) -> dict:
    """Conditional log-likelihood by Adam; each line carries its document's
    label."""
    count = np.diff(edges)
    y = np.repeat(label, count).astype(float)
    weights, trans = np.zeros(FEATURES), np.zeros((2, 2))
    inner = np.maximum(count - 1, 0)
    have = np.array([[inner[label == 0].sum(), 0], [0, inner[label == 1].sum()]], float)
    lines = max(1.0, float(count.sum()))
    m = v = np.zeros(FEATURES + 4)
    for t in range(1, _STEPS + 1):
        p, moves, _ = marginals(x @ weights, trans, edges)
        g = np.concatenate([x.T @ (p - y), (moves - have).ravel()]) / lines
        g += _L2 * np.concatenate([weights, trans.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = _RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        weights, trans = weights - step[:FEATURES], trans - step[FEATURES:].reshape(2, 2)
    s = _document_scores(x, size, edges, weights, trans)
    ok = ~np.isnan(s)
    a, b = _platt(s[ok], label[ok]) if ok.any() else (1.0, 0.0)
    return {"weights": weights, "trans": trans, "a": a, "b": b, "prior": float(label.mean()) if len(label) else 0.5}


def _extract(batches):
    for batch in batches:
        for lo, hi, buf, off in text_slices(batch.column("text")):
            x, size, edges = line_features(buf, off)
            out = [(x[a:b].astype(np.float32).tobytes(), size[a:b].astype(np.float32).tobytes()) for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(lo, hi - lo), pa.array([o[0] for o in out], pa.binary()),
                 pa.array([o[1] for o in out], pa.binary())], names=["label", "x", "size"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Fit on the first ``sample`` labelled rows, by hash, outside the held-out
    fold; null labels and ids are left out."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = (id_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
            .select("label", "text").mapInArrow(_extract, "label int, x binary, size binary").collect())
    rows.sort(key=lambda r: (r.label, bytes(r.size), bytes(r.x)))  # tasks end in any order
    x = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in rows]
    if not rows:
        return fit(np.zeros((0, FEATURES)), np.zeros(0), np.zeros(1, np.int64), np.zeros(0, int))
    edges = np.concatenate([[0], np.cumsum([len(m) for m in x])])
    return fit(np.concatenate(x).astype(float), np.concatenate([np.frombuffer(r.size, np.float32) for r in rows]).astype(float),
               edges, np.array([r.label for r in rows]))


def _scores(model: dict, texts) -> np.ndarray:
    out = np.empty(len(texts))
    for lo, hi, buf, off in text_slices(texts):
        s = _document_scores(*line_features(buf, off), model["weights"], model["trans"])
        z = 1 / (1 + np.exp(-np.clip(model["a"] * _logit(s) + model["b"], -30, 30)))
        out[lo:hi] = np.where(np.isnan(s), model["prior"], z)
    return out


def score(docs: DataFrame, model: dict) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null, empty and blank texts get the share of good labels; repeated rows score
    alike; labels without any row of training give 0.5; an empty table gives an
    empty result."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(model, batch.column("text")))],
                                             names=["doc_id", "score"])

    scored = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: dict, least: float = LEAST_SCORE) -> DataFrame:
    """The documents that score at least ``least``; columns as they came."""
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(_scores(model, texts))

    return docs.where(scored(F.coalesce(F.col("text").cast("string"), F.lit(""))) >= least)
