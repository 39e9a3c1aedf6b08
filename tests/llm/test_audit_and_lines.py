"""Filter audit and line dedup against brute-force versions, with edge rows."""

from __future__ import annotations

import hashlib
import random

import pytest

from spendcast.llm import filter_audit, line_dedup

from . import brute

LINE = "doc_id long, text string, source string, key long, keep string, `row` int, h double, n_chars int"
LABELS = "doc_id long, quality int, toxic int, n string"


def _rows(spark, rows, parts=5):
    """Rows (doc_id, text, source) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, "k", 2, 0.5, len(r[1] or "")) for r in rows], LINE).repartition(parts)


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    pool = [f"Shared line {i} of the corpus, words " + "xyzé"[i % 4] * (i % 7) for i in range(30)]
    out = []
    for i in range(160):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"only in document {i}, line {k} " + rng.choice(["", "A BIG SHOUT", "5 % & more"])
                 for k in range(rng.randint(1, 9))]
        if i % 3 == 0:
            lines = [x.upper() if k % 2 else f"\t {x}\r" for k, x in enumerate(lines)]
        out.append((i, "\n".join(lines), ["a", "b", None][i % 3]))
    long = "\n".join(f"line of a very long text, number {k % 900}" for k in range(40_000))
    words = " ".join(f"w{k}" for k in range(260))
    return out + [(500, None, None), (501, "", "a"), (502, " \t\n", "b"), (503, long, "a"), (504, long, "b"), (505, long, "a"),
                  (506, words, "a"), (507, words, "a"), (507, words, "a"), (507, words, "b"), (506, words, "c"), (508, words + "|", "a"),
                  (None, words, "a"), (None, pool[1], "a"), (None, pool[1], "a"), (None, pool[2], None), (7, pool[1], "b"), (7, pool[1], "b"),
                  (509, "ten " * 300, "a"), (510, "é" * 19 + "\n" + "É" * 20, "a"), (511, "É" * 20, "b"), (512, "É" * 20 + " ", "b"), (513, "é" * 20, "b")]


def test_filter_audit(spark, docs):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 520, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (506, None, 1), (506, 1, None)]
    marks = spark.createDataFrame([(*x, "") for x in labels], LABELS)
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in filter_audit.audit_documents(_rows(spark, docs), marks).collect()}
    assert got == brute.op12(docs, labels)
    assert filter_audit.audit_documents(_rows(spark, docs[:0]), marks).count() == 0
    none = filter_audit.audit_documents(_rows(spark, docs), marks.limit(0)).collect()
    assert len(none) == len(got) and not any(r.good_lost or r.toxic_lost for r in none)


def test_filter_audit_of_other_filters(spark):
    counts = spark.createDataFrame([("x", 0, 5), ("x", 1, 3), ("x", 3, 2), ("x", 3, 1), ("y", 2, 4)], "part string, mask int, n long")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley)
           for r in filter_audit.audit(counts, "PQ").collect()}
    assert got == {("x", "PQ", 1): (5, 6, 0, 3, 9), ("x", "PQ", 2): (5, 0, 3, 0, 3), ("x", "QP", 1): (8, 3, 0, 0, 3), ("x", "QP", 2): (5, 3, 3, 3, 9),
                   ("y", "PQ", 1): (4, 0, 0, 0, 0), ("y", "PQ", 2): (0, 4, 0, 4, 8), ("y", "QP", 1): (0, 4, 0, 4, 8), ("y", "QP", 2): (0, 0, 0, 0, 0)}


@pytest.mark.parametrize("held", [4096, 1])
def test_line_dedup(spark, docs, held, monkeypatch):
    monkeypatch.setattr(line_dedup, "_HELD", held)  # the task's function carries the value along
    pairs = [r[:2] for r in docs]
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in line_dedup.digests(_rows(spark, docs)).collect()) == order(brute.op13(pairs))
    assert order(tuple(r) for r in line_dedup.digests(_rows(spark, docs), 5, 2).collect()) == order(brute.op13(pairs, 5, 2))
    assert line_dedup.digests(_rows(spark, docs[:0])).count() == 0


def test_line_dedup_hot_line_spans_partitions(spark):
    docs = [(i, f"a line that every document holds\nown line of document {i}" + "\na line that every document holds" * (i % 2), "s") for i in range(3000)]
    got = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.digests(_rows(spark, docs)).collect()}
    assert got == {i: (2 + i % 2, 0 if i == 2999 else 1 + i % 2) for i in range(3000)}
    bitmaps = line_dedup.keep_bitmaps(_rows(spark, docs))
    assert bitmaps.count() == 2999 and bitmaps.columns == ["doc_id", "key", "keep"]


def test_line_dedup_cuts_text(spark, docs):
    frame = _rows(spark, docs)
    out = line_dedup.line_dedup(frame)
    assert out.columns == frame.columns and out.dtypes == frame.dtypes
    rows = out.collect()
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted(((r.doc_id, digest(r.text)) for r in rows), key=str) == sorted(((d, h) for d, _, _, h in brute.op13([r[:2] for r in docs])), key=str)
    assert all(r.key == 1 and r.keep == "k" and r.row == 2 and r.n_chars == len(r.text or "") for r in rows)
    assert [r.text for r in rows if r.doc_id == 500] == [None]
