"""Brute-force versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import permutations


def op9(docs, size=13):
    """docs: (doc_id, text) pairs."""
    first = {}
    split = {}
    for d, t in docs:
        w = split[d] = (t or "").encode().split()
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            first[g] = min(first.get(g, d), d)
    out = {}
    for d, w in split.items():
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < d:
                gone.update(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[d] = (len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def op1(docs, size=400):
    count = Counter()
    data = {d: (t or "").encode() for d, t in docs}
    for b in data.values():
        for i in range(len(b) - size + 1):
            count[b[i:i + size]] += 1
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i:i + size] = b"\x01" * size
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def op2(docs, size=5, num=75, den=100):
    sets, parent = {}, {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        parent[d] = d

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for d, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(d)
    pairs = Counter()
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                pairs[a, b] += 1
    for (a, b), x in pairs.items():
        if den * x >= num * (len(sets[a]) + len(sets[b]) - x):
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def op12(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    smallest = {}
    for d, t, _ in docs:
        if d is not None:
            smallest[t or ""] = min(smallest.get(t or "", d), d)
    good, toxic = ({d for d, *marks in labels if marks[k] == 1 and d is not None} for k in (0, 1))
    fails, out = {}, {}
    for d, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and smallest[t] < d}
        fails.setdefault(s or "", []).append(({x for x, bad in f.items() if bad}, d))
    for part, rows in fails.items():
        total = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, x in enumerate(order, 1):
                here = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                total[x] += len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), sum(x in f for f, _ in rows) - len(here), sum(f == {x} for f, _ in rows),
                    sum(d in good for _, d in here), sum(d in toxic for _, d in here), x]
        for (p, order, step), row in out.items():
            if p == part:
                row[-1] = total[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def op13(docs, least=20, documents=3):
    """docs: (doc_id, text); one result for each row, in order.  A missing doc_id is one unknown document, the least."""
    rank = lambda d: -(1 << 63) if d is None else d
    key = lambda line: re.sub("[A-Z]+", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(rank(d))
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or len(holders[key(x)]) < documents or max(holders[key(x)]) == rank(d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def op11(docs):
    """docs: (doc_id, text); one result for each row, in order, from whole texts."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {**{chr(x): x for x in shown}, **{chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in shown)}}
    spell_a = lambda i: bytes(shown[c] for c in a.id_to_token(i))
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode()
    links, groups, held = [], [], Counter()
    for _, t in docs:
        t = t or ""
        ia, ib = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        sa, sb = [spell_a(i) for i in ia], [spell_b(i) for i in ib]
        mine, link = [], Counter()
        if t and b"".join(sa) == b"".join(sb) == (" " + t).encode():
            ends = [set(), set()]
            at = [[], []]
            for k, s in enumerate((sa, sb)):
                end = 0
                for x in s:
                    end += len(x)
                    ends[k].add(end)
                    at[k].append(end)
            cuts = sorted(ends[0] & ends[1])
            lo = 0
            for hi in cuts:
                ga, gb = ([i for i, e in zip(ids, at[k]) if lo < e <= hi] for k, ids in enumerate((ia, ib)))
                mine.append((ga, gb))
                link.update((x, y) for x in ga for y in gb)
                lo = hi
        groups.append(mine)
        links.append(link)
        held.update(set(link))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (d, _), mine, link in zip(docs, groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in mine)
        out.append((d, sum(len(x) for x, _ in mine), sum(len(y) for _, y in mine), len(mine), sum(link.values()),
                    sum(n for p, n in link.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in link.items()),
                    hashlib.sha256(text.encode()).hexdigest() if mine else ""))
    return out
