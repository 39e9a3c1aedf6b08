"""Cross-tokenizer alignment against a brute-force version over whole texts."""

from __future__ import annotations

import random

import pytest

from spendcast.llm import token_alignment

from . import brute

ODD = ["  two  spaces", "\n\nlines\n then \n\n words  \n", "tab\there", "no break　space", "a▁b", "\x00 nul \x1c fs", "<|endoftext|> <s></s>",
       "café naïve 日本語のテキスト \U0001f642\U0001f642", " ", "\n", "don't we'll I'M", "x" * 500, "​﻿x", "ends with space ", "\r\nwin\r\n", "12345 6.7e-8 $%&", "\x85next", "é combining",
       "a" + " " * 300 + "b", "=" * 400 + " " + "-" * 77, "café" * 50]
SCHEMA = "doc_id long, text string, code long, n string, digest int"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2) for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    real = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").limit(60).collect()]
    pool = [w for t in real for w in (t or "").split()] + ODD
    made = [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 50))) for _ in range(60)]
    rows = list(enumerate([*real, *made, *ODD]))
    long = " ".join(rng.choice(pool) for _ in range(30_000))
    return rows + [(900, None), (901, ""), (902, real[3]), (902, real[3]), (None, real[3]), (None, ODD[0]), (903, long), (904, long)]


@pytest.mark.parametrize("block", [token_alignment.BLOCK, 300])
def test_measures(spark, docs, block, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK", block)
    got = [tuple(r) for r in token_alignment.measures(_frame(spark, docs)).collect()]
    assert sorted(got, key=str) == sorted(brute.op11(docs), key=str)
    assert token_alignment.measures(_frame(spark, docs[:0])).count() == 0


def test_groups_and_pair_table(spark, docs):
    some = [d for d in docs if len(d[1] or "") < 5000]
    groups = {r.doc_id: r.groups for r in token_alignment.alignments(_frame(spark, some)).collect()}
    held = {}
    for d, t in some:
        links = {(int(x), int(y)) for g in token_alignment.aligner()([t], write=True)[0].written.decode().split(";")
                 for a, b in [g.split("|")] for x in a.split(",") for y in b.split(",")} if groups[d] else set()
        for p in links:
            held[p] = held.get(p, 0) + 1
    got = {(r.a, r.b): r.documents for r in token_alignment.pair_table(_frame(spark, some)).collect()}
    assert got == held and groups[900] == groups[901] == "" and groups[902] == groups[3]


@pytest.mark.parametrize("name, value", [("_RANGE", 7), ("_WIDE", 1), ("_SLICE", 50)])
def test_slices_ranges_and_wide_groups_change_nothing(docs, name, value, monkeypatch):
    texts = [t for _, t in docs if t is not None and len(t) < 5000]
    whole = token_alignment.aligner()(texts, write=True)
    monkeypatch.setattr(token_alignment, name, value)
    parts = [x for lo, hi in token_alignment._slices(texts) for x in token_alignment.aligner()(texts[lo:hi], write=True)]
    for x, y in zip(whole, parts, strict=True):
        assert (x is None) == (y is None)
        assert not x or (x.sizes, x.digest, x.written, x.codes.tolist(), x.times.tolist()) == (
            y.sizes, y.digest, y.written, y.codes.tolist(), y.times.tolist())


def test_both_libraries_of_a_agree(docs):
    align = token_alignment.aligner()
    for _, t in docs:
        if t and not token_alignment._RARE.search(t):
            assert align.fast(" " + t) == align.a.encode(" " + t, add_special_tokens=False).ids
