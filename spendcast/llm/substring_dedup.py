"""Substring dedup: a compacted de Bruijn graph over the documents' words.

Each repeated window of ``size`` words is an edge between its first and its last
``size - 1`` words.  Paths through nodes at which nothing branches and no run
begins or ends compact to one *piece*; a piece lies whole in a document or not
at all, so one owner (the smallest doc_id that holds it) decides for all its
windows.  Junction nodes are found by a grouped aggregate and brought back to
the runs by a join; equal pieces, verified by a 128-bit digest of their words,
meet in another, which gives the source coordinates.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, pin, unwrapped, whole_rows
from .repeats import MAX_ID, Spec, cover, find_runs
from .textnum import U, Words, grams, mix, text_slices

SIZE = 13
_SEED_WORDS = 6


def _bodies(column):
    """Words and row ranges of binary bodies."""
    yield from text_slices(column.cast(pa.string()))


def _nodes(size: int):
    """(node, link): every node of a run, with one hash of the words before and
    after it; 0 stands for the run's end."""
    def run(batches):
        for batch in batches:
            ids = batch.column("run").to_numpy()
            for lo, hi, buf, off in _bodies(batch.column("body")):
                w = Words(buf, off)
                node = grams(w.prefix(), size - 1)
                count = w.count - size + 2  # nodes of each row
                first = np.repeat(w.first[:-1], count)
                j = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                at = first + j
                row = np.repeat(np.arange(hi - lo), count)
                before = np.where(j > 0, w.hash[np.maximum(at - 1, 0)], U(0))
                last = j == count[row] - 1
                after = np.where(last, U(0), w.hash[np.minimum(at + size - 1, len(w.hash) - 1)])
                link = mix(before * U(3) + mix(after))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + row]), pa.array((w.count[row]).astype(np.int32)), pa.array(j.astype(np.int32)),
                     pa.array(node[at].view(np.int64)), pa.array(link.view(np.int64))],
                    names=["run", "words", "j", "node", "link"])
    return run


def _pieces(size: int):
    """Cut each run at its junctions; digest the words of every piece."""
    def run(batches):
        for batch in batches:
            ids, cuts, owner = batch.column("run").to_numpy(), batch.column("cuts"), batch.column("owner").to_numpy()
            out = []
            for i, body in enumerate(batch.column("body").to_pylist()):
                words = body.split()
                n = len(words) - size + 1
                inner = cuts[i].as_py() or []
                edge = sorted({0, n, *inner})
                for x, y in zip(edge, edge[1:]):
                    d = hashlib.blake2b(b" ".join(words[x:y + size - 1]), digest_size=16).digest()
                    out.append((ids[i], len(words), x, y, owner[i], d))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], t) for k, t in enumerate(
                    (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                names=["run", "words", "x", "y", "owner", "piece"])
    return run


def repeated_spans(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Spans of windows that also occur in a document of smaller doc_id: key,
    ``spans`` (first word, word after the last, source document).  Only
    documents that have some."""
    runs = find_runs(docs, Spec(size, min(_SEED_WORDS, size), True, True))
    small = F.coalesce("doc_id", F.lit(MAX_ID))
    # body and n are those of one of the equal runs
    reps = pin(runs.groupBy("run", "n").agg(F.min(small).alias("owner"), F.first("body").alias("body")), "zstd")
    nodes = reps.select("run", "body").mapInArrow(
        _nodes(size), "run long, words int, j int, node long, link long")
    # pinned, so that the join below shuffles both sides and can split a hot node
    junctions = pin(nodes.groupBy("node").agg(F.min("link").alias("a"), F.max("link").alias("b"))
                    .where("a <> b").select("node"))
    cuts = (nodes.join(junctions, "node").groupBy("run", "words")
            .agg(F.collect_list("j").alias("cuts"))
            .select("run", (F.col("words") - (size - 1)).cast("long").alias("n"), "cuts"))
    pieces = pin(reps.join(cuts, ["run", "n"], "left").select("run", "owner", "body", "cuts")
                 .mapInArrow(_pieces(size), "run long, words int, x int, y int, owner long, piece binary")
                 .withColumn("n", (F.col("words") - (size - 1)).cast("long")))
    # pinned as well: a piece of very many runs, or a run of very many documents, is split
    owners = pin(pieces.groupBy("piece").agg(F.min("owner").alias("source")))
    parts = pin(pieces.join(owners, "piece").groupBy("run", "n")
                .agg(F.collect_list(F.struct("x", "y", "source")).alias("parts")))
    spans = (runs.select("key", small.alias("doc"), "run", "s", "n").distinct().join(parts, ["run", "n"])
             .select("key", "doc", "s", F.explode("parts").alias("p")).where("p.source < doc")
             .select("key", F.struct((F.col("s") + F.col("p.x")).alias("lo"),
                                     (F.col("s") + F.col("p.y") + (size - 1)).alias("hi"),
                                     F.col("p.source").alias("source")).alias("span")))
    return spans.groupBy("key").agg(F.collect_list("span").alias("spans"))


def _keep_mask(n: int, spans) -> np.ndarray:
    if not spans:
        return np.ones(n, bool)
    return ~cover(np.array([s["lo"] for s in spans]), np.array([s["hi"] for s in spans]), n)


def _digests(batches):
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("spans").to_pylist()
        n, gone, sha = [], [], []
        for i, text in enumerate(texts):
            words = text.as_py().encode().split()
            if spans[i]:
                keep = _keep_mask(len(words), spans[i])
                kept = [w for w, k in zip(words, keep.tolist()) if k]
            else:
                kept = words
            n.append(len(words))
            gone.append(len(words) - len(kept))
            sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array(sha)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def digests(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    Null and empty texts have no words; texts shorter than a window lose none;
    rows that agree in id and text get equal rows; a null doc_id counts as larger
    than any; an empty table gives an empty result."""
    found = repeated_spans(docs, size)
    return (keyed(docs).join(found, "key", "left").select("doc_id", "text", "spans")
            .mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def substring_dedup(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The documents with later copies of repeated spans cut out of ``text``;
    ``n_chars``, if present, follows.  A cut text is its kept words joined by one
    space; documents that lose nothing keep theirs, null included."""
    joined = whole_rows(docs).join(repeated_spans(docs, size), "key", "left")
    text, whole = F.col("row.text"), F.col("spans").isNull()
    cut = F.when(whole, text).otherwise(_cut_text(text, F.col("spans")))
    joined = joined.select("row", whole.alias("whole"), cut.alias("cut"))
    new = {"text": F.col("cut")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("whole"), F.col("row.n_chars")).otherwise(F.length("cut").cast(docs.schema["n_chars"].dataType))
    return unwrapped(joined, docs.columns, new)


def _cut_text(text, spans):
    """Kept words of a text, joined by one space."""
    @F.arrow_udf("string")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts.to_pylist(), found.to_pylist()):
            if not s:
                out.append(t)
                continue
            words = t.encode().split()
            keep = _keep_mask(len(words), s)
            out.append(b" ".join(w for w, k in zip(words, keep.tolist()) if k).decode())
        return pa.array(out, pa.string())

    return cut(text, spans)
