"""Suffix-array dedup of byte strings, by longest-previous-factor arrays.

Runs of windows that may repeat come from ``repeats``.  Equal windows choose the
same seed, so a seed's *contexts* (the bytes around one place of it) hold every
suffix that can match another.  Where all contexts of a seed are equal, all
their suffixes match, and the smallest position is the earlier match.  The rest
go to suffix arrays, built per group of seeds by prefix doubling to the depth of
a window: suffixes of equal rank agree in ``size`` bytes.  With equal ranks in
order of position, a suffix's previous smaller position is its left neighbour,
and its next smaller one lies beyond the class, where the common prefix is too
short; so the first of a class is the earliest factor and all others are later
copies of it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, pin, shuffle_partitions, unwrapped, whole_rows
from .repeats import MAX_ID, Spec, View, cover, find_runs, seeds
from .textnum import U, mix, span, text_slices

SIZE = 400
_SEED_BYTES = 64
#: Contexts of one seed beyond which its suffixes are dealt out by the bytes
#: they share rather than kept in one group; results are the same.
SPLIT_OVER = 4096
_STEP = 25
_BATCH = 1 << 20


def rank_by_prefix(buf: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` bytes (shorter ones sort as if
    zeros followed), by prefix doubling."""
    n = len(buf)

    def dense(code):
        order = np.argsort(code)
        s = code[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]])) + 1
        return rank

    def ahead(rank, by):
        out = np.zeros(n, np.int64)
        if by < n:
            out[:n - by] = rank[by:]
        return out

    width = min(7, depth)
    code = np.zeros(n, np.int64)
    for i in range(width):
        code = (code << 8) | ahead(buf.astype(np.int64), i)
    rank = dense(code)
    while width < depth:
        step = min(width, depth - width)
        rank = dense(rank * (n + 1) + ahead(rank, step))
        width += step
    return rank


def earliest_factor(rank: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every suffix the index of the earliest suffix that shares its prefix,
    and the class that the two are in."""
    order = np.lexsort((pos, doc, rank))
    r = rank[order]
    begin = np.concatenate([[True], r[1:] != r[:-1]])
    cls = np.cumsum(begin) - 1
    source, of = np.empty(len(r), np.int64), np.empty(len(r), np.int64)
    source[order], of[order] = order[np.flatnonzero(begin)][cls], cls
    return source, of


_CONTEXT = ("run long, n long, fp long, ctx long, lo long, m long, a long, w long, src_doc long, src_pos long")


def _contexts(spec: Spec):
    def run(batches):
        for batch in batches:
            col = {c: batch.column(c).to_numpy() for c in ("run", "n", "w", "src_doc", "src_s")}
            for lo, hi, buf, off in text_slices(_as_text(batch.column("body"))):
                view = View(buf, off, False)
                h, a, s, e, row = seeds(view, spec)
                ctx = span(view.pre, s, e + spec.size) ^ mix((a - s).astype(np.uint64) + U(1))
                at = s - off[row]
                i = lo + row
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col["run"][i]), pa.array(col["n"][i]), pa.array(h.view(np.int64)),
                     pa.array(ctx.view(np.int64)), pa.array(at), pa.array(e - s + 1), pa.array(a - s),
                     pa.array(col["w"][i]), pa.array(col["src_doc"][i]), pa.array(col["src_s"][i] + at)],
                    names=[c.split()[0] for c in _CONTEXT.split(", ")])
    return run


def _as_text(column) -> pa.Array:
    """A binary column as string buffers, unchecked: runs may cut characters."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pa.Array.from_buffers(pa.string(), len(column), column.buffers(), column.null_count, column.offset)


_MEMBER = "fp long, grp long, ctx long, first long, m long, w long, src_doc long, src_pos long, bytes binary"


def _cut(size: int):
    """The bytes of the contexts asked for.  Those of a seed with very many are
    cut by anchor distance and grouped by the bytes that each cut's windows all
    hold."""
    def run(batches):
        for batch in batches:
            out = []
            for body, wanted in zip(batch.column("body").to_pylist(), batch.column("wanted").to_pylist()):
                for c in wanted:
                    whole = body[c["lo"]:c["lo"] + c["m"] - 1 + size]
                    if not c["big"]:
                        out.append((c["fp"], c["fp"], c["ctx"], 0, c["m"], c["w"], c["src_doc"], c["src_pos"], whole))
                        continue
                    x = 0
                    while x < c["m"]:  # window x lies a - x bytes before the anchor
                        q = (c["a"] - x) // _STEP
                        y = min(c["m"], c["a"] - q * _STEP + 1)
                        near = c["a"] - q * _STEP
                        core = whole[near:near - (_STEP - 1) + size]
                        g = hashlib.blake2b(core + q.to_bytes(4, "little", signed=True), digest_size=8).digest()
                        out.append((c["fp"], int.from_bytes(g, "little", signed=True), c["ctx"], x, y - x, c["w"],
                                    c["src_doc"], c["src_pos"] + x, whole[x:y - 1 + size]))
                        x = y
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[k] for o in out], pa.binary() if k == 8 else pa.int64()) for k in range(9)],
                    names=[c.split()[0] for c in _MEMBER.split(", ")])
    return run


_VERDICT = "fp long, ctx long, x long, y long, src_doc long, src_pos long"


def _suffix_arrays(size: int):
    def solve(rows):
        fp, ctx, first, m, w, doc, pos = (np.array([r[k] for r in rows], np.int64) for k in (0, 2, 3, 4, 5, 6, 7))
        buf = np.frombuffer(b"".join(r[8] for r in rows), np.uint8)
        base = np.cumsum([0] + [len(r[8]) for r in rows[:-1]])
        of = np.repeat(np.arange(len(rows)), m)
        o = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        rank = rank_by_prefix(buf, size)[base[of] + o]
        source, cls = earliest_factor(rank, doc[of], pos[of] + o)
        again = np.bincount(cls, w[of])[cls] > 1
        k = np.flatnonzero(again)
        if not len(k):
            return None
        sd, sp, kof, ko = doc[of[source[k]]], (pos[of] + o)[source[k]], of[k], o[k]
        cut = np.concatenate([[True], (kof[1:] != kof[:-1]) | (ko[1:] != ko[:-1] + 1)
                              | (sd[1:] != sd[:-1]) | (sp[1:] != sp[:-1] + 1)])
        b = np.flatnonzero(cut)
        last = np.concatenate([b[1:], [len(k)]]) - 1
        i = kof[b]
        return pa.RecordBatch.from_arrays(
            [pa.array(v) for v in (fp[i], ctx[i], first[i] + ko[b], first[i] + ko[last] + 1, sd[b], sp[b])],
            names=[c.split()[0] for c in _VERDICT.split(", ")])

    def run(batches):
        rows, held, group = [], 0, None
        for batch in batches:  # sorted by group
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if held >= _BATCH and r[1] != group:
                    if (out := solve(rows)) is not None:
                        yield out
                    rows, held = [], 0
                group = r[1]
                rows.append(r)
                held += len(r[8])
        if rows and (out := solve(rows)) is not None:
            yield out
    return run


def repeated_spans(docs: DataFrame, size: int = SIZE, keep: str = "first") -> DataFrame:
    """Byte spans covered by strings of ``size`` bytes that also start elsewhere:
    key and ``spans`` (lo, hi).  ``keep="first"`` spares the earliest copy (by
    doc_id, then place), ``keep="none"`` spares none."""
    if keep not in ("first", "none"):
        raise ValueError(f"keep is 'first' or 'none', not {keep!r}")
    spec = Spec(size, min(_SEED_BYTES, size), False, False)
    runs = find_runs(docs, spec)
    small = F.coalesce("doc_id", F.lit(MAX_ID))
    reps = pin(runs.groupBy("run", "n").agg(F.count(F.lit(1)).alias("w"), F.min(F.struct(small.alias("d"), "s")).alias("src"),
                                            F.first("body").alias("body")), "zstd")
    contexts = pin(reps.select("run", "n", "w", F.col("src.d").alias("src_doc"), F.col("src.s").alias("src_s"), "body")
                   .mapInArrow(_contexts(spec), _CONTEXT))
    by_seed = pin(contexts.groupBy("fp").agg(
        F.min("ctx").alias("c0"), F.max("ctx").alias("c1"), F.sum("w").alias("total"), F.count(F.lit(1)).alias("k"),
        F.min(F.struct("src_doc", "src_pos")).alias("src")).where("total > 1"))
    alike = (contexts.select("run", "n", "fp", "lo", "m").join(by_seed.where("c0 = c1").select("fp", "src"), "fp")
             .select("run", "n", F.col("lo").alias("x"), (F.col("lo") + F.col("m")).alias("y"), "src.src_doc", "src.src_pos"))
    mixed = by_seed.where("c0 <> c1").select("fp", (F.col("k") > SPLIT_OVER).alias("big"))
    members = (contexts.join(mixed, "fp").groupBy("fp", "ctx", "big")
               .agg(F.sum("w").alias("w"), F.min(F.struct("src_doc", "src_pos")).alias("src"),
                    F.min(F.struct("run", "n", "lo", "m", "a")).alias("at")))
    wanted = (members.groupBy("at.run", "at.n")
              .agg(F.collect_list(F.struct("fp", "ctx", "big", "w", "src.src_doc", "src.src_pos", "at.lo", "at.m", "at.a"))
                   .alias("wanted")))
    verdicts = (reps.select("run", "n", "body").join(wanted, ["run", "n"]).select("body", "wanted")
                .mapInArrow(_cut(size), _MEMBER)
                .repartition(shuffle_partitions(docs.sparkSession), "grp").sortWithinPartitions("grp")
                .mapInArrow(_suffix_arrays(size), _VERDICT))
    unlike = (contexts.select("run", "n", "fp", "ctx", "lo").join(verdicts, ["fp", "ctx"])
              .select("run", "n", (F.col("lo") + F.col("x")).alias("x"), (F.col("lo") + F.col("y")).alias("y"),
                      "src_doc", "src_pos"))
    parts = (alike.unionByName(unlike).groupBy("run", "n")
             .agg(F.collect_list(F.struct("x", "y", "src_doc", "src_pos")).alias("parts")))
    placed = (runs.select("key", small.alias("doc"), "run", "s", "n").distinct().join(parts, ["run", "n"])
              .select("key", "doc", "s", F.explode("parts").alias("p")))
    if keep == "first":
        placed = placed.where("not (p.src_doc = doc and p.src_pos = s + p.x)")
    return (placed.groupBy("key").agg(F.collect_list(F.struct(
        (F.col("s") + F.col("p.x")).alias("lo"), (F.col("s") + F.col("p.y") + (size - 1)).alias("hi"))).alias("spans")))


def _mask(n: int, spans) -> np.ndarray:
    return cover(np.array([s["lo"] for s in spans]), np.array([s["hi"] for s in spans]), n)


def _digests(batches):
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("spans").to_pylist()
        out = []
        for i, text in enumerate(texts):
            data = text.as_py().encode()
            gone, runs, kept = 0, 0, data
            if spans[i]:
                mask = _mask(len(data), spans[i])
                gone = int(mask.sum())
                runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
            out.append((len(data), gone, runs, hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")] + [pa.array([o[k] for o in out], pa.string() if k == 3 else pa.int64()) for k in range(4)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def digests(docs: DataFrame, size: int = SIZE, keep: str = "none") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null and empty texts have no bytes; texts shorter than ``size`` lose none;
    rows that agree in id and text count as copies of each other; a null doc_id
    is larger than any; an empty table gives an empty result."""
    found = repeated_spans(docs, size, keep)
    return (keyed(docs).join(found, "key", "left").select("doc_id", "text", "spans")
            .mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def suffix_dedup(docs: DataFrame, size: int = SIZE, keep: str = "first") -> DataFrame:
    """The documents with repeated byte strings cut out of ``text``; characters
    that a cut splits go with it.  Other columns stay as they are."""
    joined = whole_rows(docs).join(repeated_spans(docs, size, keep), "key", "left")

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts.to_pylist(), spans.to_pylist()):
            if s:
                data = t.encode()
                t = np.frombuffer(data, np.uint8)[~_mask(len(data), s)].tobytes().decode("utf-8", "ignore")
            out.append(t)
        return pa.array(out, pa.string())

    text = F.col("row.text")
    new = F.when(F.col("spans").isNull(), text).otherwise(cut(text, F.col("spans")))
    return unwrapped(joined.select("row", new.alias("cut")), docs.columns, {"text": F.col("cut")})
