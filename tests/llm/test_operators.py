"""Each operator against a brute-force version, round trips and edge rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendcast.llm import (exact_dedup, merge_dropout, near_dedup, packing, quality_crf, quality_rules, substring_dedup,
                           suffix_dedup, toxicity, url_filters)

from . import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, row string"


def _frame(spark, texts, parts=4):
    rows = [(i, t, "en", "s", len(t or ""), 7, "x") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 60)}" for _ in range(rng.randint(1, 60))] for _ in range(12)]
    out = []
    for i in range(150):
        w = list(rng.choice(base)) + (list(rng.choice(base)) if i % 4 == 0 else [])
        for _ in range(rng.choice([0, 0, 1, 1, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 5)}"
        out.append((i, (" " if i % 3 else "\n").join(w).replace("w1 ", "é1 ")))
    long = " ".join(f"l{rng.randint(0, 9)}" for _ in range(6000))
    return out + [(500, None), (501, ""), (502, " \t\n"), (503, "a" * 900), (504, "a " * 300), (505, long), (506, long)]


def _empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring_dedup(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.digests(_frame(spark, texts)).collect()}
    assert got == brute.op9(texts)
    assert substring_dedup.digests(_empty(spark)).count() == 0


def test_substring_dedup_cuts_text(spark, texts):
    docs = _frame(spark, texts)
    out = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).collect()}
    want = brute.op9(texts)
    assert len(out) == len(texts) and substring_dedup.substring_dedup(docs).columns == docs.columns
    for i, t in texts:
        if want[i][1]:
            assert hashlib.sha256(out[i].text.encode()).hexdigest() == want[i][2] and out[i].n_chars == len(out[i].text)
        else:
            assert out[i].text == t


@pytest.mark.parametrize("split", [4096, 3])
def test_suffix_dedup(spark, texts, split, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPLIT_OVER", split)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(_frame(spark, texts), size=60).collect()}
    assert got == brute.op1(texts, 60)
    assert suffix_dedup.digests(_empty(spark)).count() == 0


def test_suffix_dedup_keeps_first(spark):
    copy = "".join(random.Random(1).choices("abcdefgh", k=100))
    docs = _frame(spark, [(1, "left " + copy), (2, copy + " right"), (3, "alone")])
    out = {r.doc_id: r.text for r in suffix_dedup.suffix_dedup(docs, size=60).collect()}
    assert out[1] == "left " + copy and out[2] == " right" and out[3] == "alone"


def test_prefix_ranks_sort_suffixes():
    data = np.frombuffer(b"abracadabra" * 5, np.uint8)
    for depth in (3, 8, 20):
        rank = suffix_dedup.rank_by_prefix(data, depth)
        cut = [bytes(data[i:i + depth]) for i in range(len(data))]
        assert sorted(range(len(cut)), key=lambda i: (rank[i], i)) == sorted(range(len(cut)), key=lambda i: (cut[i], i))


def test_near_dedup(spark, texts):
    docs = _frame(spark, texts)
    want = brute.op2(texts)
    assert {r.doc_id: tuple(r)[1:] for r in near_dedup.decisions(docs).collect()} == want
    assert {r.doc_id for r in near_dedup.near_dedup(docs).collect()} == {i for i, w in want.items() if w[2]}
    assert near_dedup.decisions(_empty(spark)).count() == 0


def test_words_of_empty_slices(monkeypatch):
    """A worker's first slice may hold no byte."""
    import numpy as np

    from spendcast.llm import textnum
    monkeypatch.setattr(textnum, "_POWERS", {})
    words = textnum.Words(np.zeros(0, np.uint8), np.zeros(3, np.int64))
    assert list(words.count) == [0, 0] and len(words.hash) == 0 and len(textnum.grams(words.prefix(), 5)) == 0


def test_exact_dedup(spark, texts):
    docs = _frame(spark, texts + [(7, texts[7][1])])  # a row twice
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i, t in texts + [(7, texts[7][1])]:
        groups.setdefault(strip(t), []).append((-len(t or ""), i))
    rows = exact_dedup.decisions(docs).collect()
    assert len(rows) == len(texts) + 1 and sum(r.kept for r in rows) == len(groups)
    by_id = dict(texts)
    for r in rows:
        g = groups[strip(by_id[r.doc_id])]
        assert (r.keep_id, r.group_size) == (min(g)[1], len(g))
        assert r.text_sha256 == hashlib.sha256(strip(by_id[r.doc_id]).encode()).hexdigest()
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(min(g)[1] for g in groups.values())
    assert exact_dedup.decisions(_empty(spark)).count() == 0


def test_exact_dedup_without_broadcast(spark, texts, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", 0)
    rows = exact_dedup.decisions(_frame(spark, texts)).collect()
    assert sum(r.kept for r in rows) == len({re.sub(r"\s", "", t or "") for _, t in texts})


def test_exact_dedup_moves_no_text(spark, texts, monkeypatch):
    """Beyond one broadcast the positions go out in slices; rows are neither shuffled nor sorted."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_BYTES", 4096)
    docs = _frame(spark, texts)
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact_dedup.exact_dedup(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") >= 2 and "hashpartitioning" not in plan and "Sort" not in plan
        rows = exact_dedup.decisions(docs).collect()
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.kept)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert len(rows) == len(texts)


def test_quality_rules_base(spark, texts):
    for r in quality_rules.judge(_frame(spark, texts)).collect():
        t = dict(texts)[r.doc_id] or ""
        w = re.findall("[^\x20\x09-\x0D]+", t)
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(_empty(spark)).count() == 0


def test_quality_rules_word_distance(spark):
    """Common words are whole words, whatever signs they hold."""
    import math
    words = ["a.b", "$", "|", "(x", "x)", "\\Q", "\\E", "[a-z]", "^", "é", "\U0001f600", "\u00a0", "-", "*", "the", "the."]
    texts = [(i, " ".join((words * 20)[i * 7:i * 7 + 130 + i] + ["thethe", "a-b"] * i)) for i in range(4)] + [(9, None)]
    split = {i: re.findall("[^\x20\x09-\x0D]+", t or "") for i, t in texts}
    counts = Counter(w for ws in split.values() for w in ws)
    common = sorted(counts, key=lambda w: (-counts[w], w.encode()))[:quality_rules.COMMON_WORDS]
    q = [counts[w] / sum(counts.values()) for w in common]
    term = lambda x, m: x * math.log2(x / m) if x > 0 else 0.0
    for r in quality_rules.judge(_frame(spark, texts)).collect():
        ws, want = split[r.doc_id], 0.0
        if len(ws) >= quality_rules.LEAST_WORDS:
            p = [ws.count(w) / len(ws) for w in common]
            pairs = zip(p + [1 - sum(p)], q + [1 - sum(q)])
            want = math.sqrt(max(0.0, sum(term(x, (x + y) / 2) + term(y, (x + y) / 2) for x, y in pairs) / 2))
        assert abs(r.word_distance - want) < 1e-6


def test_quality_rules_every_language(spark, monkeypatch):
    name = lambda k: chr(97 + k // 10) + chr(97 + k % 10)
    rows = [(2 * k + j, f"{name(k)} {name(k)}x " * 80, name(k), "s", 1, 7, "x") for k in range(40) for j in range(2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.ref for r in quality_rules.references(docs).collect()} == {None, *(name(k) for k in range(40))}
    for most in (2000, 0):
        monkeypatch.setattr(quality_rules, "BROADCAST_REFERENCES", most)
        out = quality_rules.distances(docs).collect()
        assert len(out) == 80 and all(r.word_distance < 1e-6 and r.char_distance < 1e-6 for r in out)


def test_packing(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = texts + [(600, "  a  b  c <|endoftext|> d"), (601, "x\x85 y 　z")]
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts}
    bins = {}
    rows = packing.pack(_frame(spark, texts)).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(_empty(spark)).count() == 0


def test_packing_plan_fills():
    rng = random.Random(2)
    counts = dict(Counter(rng.randint(1, 1024) for _ in range(20000)))
    steps = packing.plan(counts)
    assert sum(counts.values()) == 20000
    top = max(first + -(-1 // per) for _, _, first, per, _ in steps)
    assert top < sum(n * c for n, c in counts.items()) / 1024 * 1.2


@pytest.mark.parametrize("counts, want", [({400: 1, 350: 1}, 1), ({400: 3, 350: 1}, 2), ({n: 1 for n in range(342, 513)}, 86)])
def test_packing_plan_pairs_odd_large_pieces(counts, want):
    bins = {}
    steps = packing.plan(counts)
    for n, c in counts.items():
        mine = [s[1:] for s in steps if s[0] == n]
        for r in range(c):
            rank, first, per, _ = [m for m in mine if m[0] <= r][-1]
            at = first + (r - rank) // per
            bins[at] = bins.get(at, 0) + n
    assert len(bins) == want and max(bins.values()) <= 1024


def test_quality_crf(spark):
    good = "The quick fox walks over the hill and rests.\nIt sleeps in the sun, then goes home."
    bad = "BUY!! NOW!! CHEAP!! PILLS!!\nBUY!! NOW!! CHEAP!! PILLS!!"
    texts = [(i, good if i % 3 else bad) for i in range(120)] + [(500, None), (501, ""), (502, "\n\n")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)] + [(None, 1), (3, None)], "doc_id long, quality int")
    docs = _frame(spark, texts)
    model = quality_crf.train(docs, labels)
    rows = {r.doc_id: r for r in quality_crf.score(docs, model).collect()}
    for i, _ in texts[:120]:
        assert rows[i].predicted == int(i % 3 > 0) and rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    assert rows[500].score == rows[501].score == rows[502].score == pytest.approx(model["prior"])
    kept = quality_crf.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == 83
    assert quality_crf.score(_empty(spark), quality_crf.train(_empty(spark), labels.limit(0))).count() == 0


def test_crf_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    emit, trans, edges = rng.normal(size=5), rng.normal(size=(2, 2)), np.array([0, 3, 3, 5])
    got, _, log_z = quality_crf.marginals(emit, trans, edges)
    total = 0.0
    for lo, hi in ((0, 3), (3, 5)):
        n, mass, z = hi - lo, np.zeros(hi - lo), 0.0
        for k in range(2**n):
            y = [(k >> i) & 1 for i in range(n)]
            w = np.exp(sum(emit[lo + i] * y[i] for i in range(n)) + sum(trans[y[i], y[i + 1]] for i in range(n - 1)))
            z += w
            mass += w * np.array(y)
        total += np.log(z)
        assert np.allclose(got[lo:hi], mass / z)
    assert log_z == pytest.approx(total)


def test_toxicity_index_is_exact():
    rng = np.random.default_rng(1)
    v = rng.random((200, 12)) * (rng.random((200, 12)) < 0.3)
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    v = np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)
    index = toxicity.Index(v, np.zeros(200, int), np.arange(200))
    for _ in range(20):
        q = rng.random(12) * (rng.random(12) < 0.4)
        t = np.flatnonzero(q)
        if len(t):
            q /= np.sqrt((q * q).sum())
            _, cos = index.nearest(t, q[t], 10)
            all_cos = np.sort(index.vectors @ q)[::-1][:10]
            assert np.allclose(cos, all_cos[all_cos > 0])


def test_toxicity(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [(i, " ".join(word() for _ in range(30)) + (" you moron trash" if i % 4 == 0 else "")) for i in range(200)]
    texts += [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
    docs = _frame(spark, texts)
    rows = {r.doc_id: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert all(rows[i].predicted == int(i % 4 == 0) for i in range(200))
    assert rows[0].evidence[0].toxic == 1 and rows[900].score == rows[901].score < 0.5
    assert toxicity.score(_empty(spark), toxicity.train(_empty(spark), labels.limit(0))).count() == 0


def test_toxicity_searches_all_terms(spark):
    """Texts without a telling term still find their neighbours."""
    letters = "abcdefg"
    texts = [(i, f"x{letters[i % 7]} y{letters[i % 7]} z{letters[i % 7]}{letters[i // 7 % 7]}{'q' * (i // 49)}") for i in range(70)]
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(70)], "doc_id long, toxic int")
    docs = _frame(spark, texts)
    model = toxicity.train(docs, labels, terms=0)
    rows = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    learned = [t for i, t in texts if zlib.crc32(str(i).encode()) % 5]
    assert len(model["vocabulary"]) == len({w for t in learned for w in t.split()})
    for i in range(70):
        assert rows[i].predicted == int(i % 7 == 0)
        assert {e.doc_id % 7 for e in rows[i].evidence} == {i % 7}


def test_url_rules_and_templates(spark):
    urls = ["http://A.ORG/x", "https://b.example.org/es/1", "http://example.org/en/17?q", "http://example.org/en/2", "ftp://q.com/fr/9#t",
            "http://com/de/", "http://x.net", None, "no scheme", "http://notorg/x", "http://spam.net/buy/1", "http://org"]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(100 + i, f"http://spam.net/buy/{i}") for i in range(60)],
                                  "page_id long, url string")
    labels = spark.createDataFrame([(100 + i, 0) for i in range(60)] + [(0, 1), (4, None)], "page_id long, good int")
    rows = {r.page_id: r for r in url_filters.judge(pages, labels).collect()}
    assert len(rows) == len(urls) + 60
    assert [rows[i].rule for i in range(len(urls))] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/",
                                                        None, None, None, None, None, None]
    assert [rows[i].verdict for i in (0, 1, 2, 3, 4, 5)] == ["allow", "block", "block", "allow", "allow", "block"]
    assert (rows[0].host, rows[2].path, rows[7].host, rows[8].path, rows[6].path) == ("a.org", "/en/17", "", "", "")
    assert rows[10].verdict == "block" and rows[10].template == "spam.net/buy/*"
    assert url_filters.judge(pages.limit(0), labels).count() == 0


def test_url_tree_rejects_a_bad_directory(spark):
    name = lambda i: "".join("abcdefghij"[int(c)] for c in f"{i:03d}")
    urls = [(f"http://h.com/news/{name(i % 10)}/x", 1) for i in range(10000)] + [(f"http://h.com/spam/{name(i % 200)}/x", 0) for i in range(600)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)] + [(20000, "http://h.com/spam/new/x")], "page_id long, url string")
    labels = spark.createDataFrame([(i, g) for i, (_, g) in enumerate(urls)], "page_id long, good int")
    rows = {r.page_id: r.verdict for r in url_filters.judge(pages, labels, rules=[]).collect()}
    assert len(rows) == len(urls) + 1 and rows[20000] == "block"
    assert all(rows[i] == ("allow" if g else "block") for i, (_, g) in enumerate(urls))


def test_merge_dropout(spark, texts):
    import public_tokenizers
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    some = texts + [(700, "a▁b  ▁ c"), (701, "日本 <s> \x00 é😀")]
    docs = _frame(spark, some)
    plain = {r.doc_id: r.ids for r in merge_dropout.encode(docs, dropout=0.0).collect()}
    assert all(plain[i] == sp.encode(t or "") for i, t in texts)
    a = {r.doc_id: r.ids for r in merge_dropout.encode(docs, seed=1).collect()}
    assert a == {r.doc_id: r.ids for r in merge_dropout.encode(docs, seed=1).collect()}
    assert a != plain and a != {r.doc_id: r.ids for r in merge_dropout.encode(docs, seed=2).collect()}
    back = {r.doc_id: r.text for r in merge_dropout.decode(merge_dropout.encode(docs)).collect()}
    assert back == {i: t or "" for i, t in some}
    rows = merge_dropout.digests(docs).collect()
    assert all(r.lossless and r.n_ids == len(a[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(a[r.doc_id], "<u4").tobytes()) for r in rows)
    assert merge_dropout.digests(_empty(spark)).count() == 0


def test_merge_dropout_cuts_each_occurrence_anew(spark):
    texts = [(i, " ".join(["understanding"] * 200)) for i in range(3)]
    rows = {r.doc_id: r.ids for r in merge_dropout.encode(_frame(spark, texts)).collect()}
    assert rows[0] != rows[1] != rows[2] != rows[0]
    pieces = merge_dropout.encoder().pieces
    for ids in rows.values():
        cuts, word = Counter(), []
        for i in [*ids, None]:
            if word and (i is None or pieces.bytes[i][:1] == b" "):
                cuts[tuple(word)] += 1
                word = []
            word.append(i)
        assert len(cuts) > 5


def _merge_by_merge(enc, text, doc_id):
    """Plain version: of all neighbours in the whole text that may merge, the best, then leftmost, until none is left."""
    pieces, stream = enc.pieces, enc.stream_of(doc_id)
    symbols = [(c, i, i + 1) for i, c in enumerate((" " + text).replace(" ", "▁") if text else "")]
    while True:
        best = min(((pieces.merges[a[0] + b[0]][0], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))
                    if a[0] + b[0] in pieces.merges and not enc.skips(stream, a[1], b[2])), default=None)
        if best is None:
            break
        (a, lo, _), (b, _, hi) = symbols[best[1]:best[1] + 2]
        symbols[best[1]:best[1] + 2] = [(a + b, lo, hi)]
    out = []
    for s, _, _ in symbols:
        out += [pieces.merges[s][1]] if s in pieces.merges else [pieces.byte[b] for b in s.encode()]
    return out


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_merge_dropout_against_merge_by_merge(dropout):
    """Array blocks and heaps give what a plain agenda gives with the same skips; a repeated
    row, its neighbours in a slice, and the slice's size change nothing."""
    import public_tokenizers
    enc = merge_dropout.Encoder(public_tokenizers.path(merge_dropout.MODEL), dropout, seed=3)
    rng = random.Random(4)
    texts = ["", "a", " ", "\n\n x\n  y ", "naïve café 日本語 é😀", "understanding " * 5, "x" * 90, "the " * 40]
    texts += ["".join(rng.choice("aeinrst") for _ in range(n)) for n in (1, 2, 3, 4, 5, 8, 9, 16, 17, 33, 64, 65, 66, 130, 300)]
    texts += ["".join(rng.choice("aeinrst  ,.\nTh1é日") for _ in range(200)) for _ in range(10)]
    doc_ids = list(range(len(texts)))
    found = [i.tolist() for i in enc(texts, doc_ids)]
    assert found == [_merge_by_merge(enc, t, d) for t, d in zip(texts, doc_ids)]
    assert [i.tolist() for i in enc.slices(texts, doc_ids)] == found
    assert all(enc([t, t], [d, d])[1].tolist() == f for t, d, f in zip(texts, doc_ids, found))
    assert all(enc.pieces.decode(f) == t for t, f in zip(texts, found))


def test_merge_dropout_long_text():
    """A text above a slice, with a chunk of very many characters, decodes to itself."""
    enc = merge_dropout.encoder()
    text = "lorem ipsum dolor ▁ sit\n" * 15000 + "etaoin" * 5000
    assert len(text) > merge_dropout.SLICE
    a, b, c = enc.slices(["before", text, "after"], [1, 2, None])
    assert enc.pieces.decode(b) == text and enc.pieces.decode(a) == "before" and enc.pieces.decode(c) == "after"


def test_near_copies_on_both_sides_of_the_threshold(spark):
    """A group of near copies, most of them a little below the threshold, some in chains above
    it, of unlike lengths: components as brute force finds them."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(10**6)}" for _ in range(160)]

    def changed(words, k):
        words = list(words)
        for i in rng.sample(range(len(words)), k):
            words[i] = f"x{rng.randrange(10**6)}"
        return words[:len(words) - rng.randrange(25)]

    group = [changed(base, rng.choice([3, 4, 5])) for _ in range(250)]
    group += [changed(rng.choice(group), rng.choice([1, 2, 3, 4])) for _ in range(150)]
    texts = [(i, " ".join(w)) for i, w in enumerate(group)] + [(len(group), " ".join(base))]
    want = brute.op2(texts)
    rows = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.decisions(_frame(spark, texts)).collect()}
    assert rows == {i: tuple(w) for i, w in want.items()}
    assert 1 < len({w[1] for w in want.values()}) < len(texts)


def test_parity_bitmaps_bound_the_difference():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(-2**63, 2**63 - 1, n)) for n in (1, 40, 700)]
    sets += [np.unique(np.concatenate([s[::2], rng.integers(-2**63, 2**63 - 1, 7)])) for s in sets]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    odd = near_dedup._parities(np.concatenate(sets), row, len(sets) + 1).to_pylist()
    assert not any(odd[-1].values())
    for a, x in zip(sets, odd):
        for b, y in zip(sets, odd):
            bits = sum(((x[k] ^ y[k]) & (1 << 64) - 1).bit_count() for k in x)
            assert bits <= len(np.setxor1d(a, b)) and bits % 2 == len(np.setxor1d(a, b)) % 2


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    step = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in step.collect()]
        step = stage(spark, step, SF)
        assert step.columns == docs.columns
        after = {r.doc_id: r.text for r in step.collect()}
        if name == "near_dedup":
            assert set(after) == {i for i, w in brute.op2(before).items() if w[2]}
        if name == "exact_dedup":
            assert len(after) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in before})
        if name == "substring_dedup":
            want = brute.op9(before)
            assert all(hashlib.sha256(" ".join(after[i].encode().decode().split(" ")).encode()).hexdigest() == w[2]
                       for i, w in want.items() if w[1])
    assert corpus_pipeline.run(spark, SF).where(F.col("length") > 0).count() >= step.count()


@pytest.mark.parametrize("apply", [near_dedup.near_dedup, substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, exact_dedup.exact_dedup])
def test_further_columns_come_back_as_they_were(spark, apply):
    names = ["_key", "_spans", "key", "spans", "row", "whole", "cut", "set", "n", "a.b"]
    copy = " ".join(f"word{i}" for i in range(120))
    rows = [(1, copy, *names), (2, copy + " more", *names), (3, None, *names), (4, "", *names), (5, "alone", *names), (5, "alone", *names), (None, copy, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    out = apply(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert got and all(list(r)[2:] == names for r in got)
    assert {r.doc_id for r in got} >= {1, 3, 5} and apply(docs.limit(0)).count() == 0
