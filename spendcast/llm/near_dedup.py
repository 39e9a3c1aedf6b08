"""MinHash near-dedup with bottom-k sketches from one hash function.

1. A document's set is its distinct 5-word shingles, as 64-bit hashes; documents
   with equal sets collapse to one *set* row.  The sketch is the K smallest.
2. Inverted lists of retained values.  Two similar sets share at least ``need``
   values of their sketches, so after ordering each sketch from its rarest value
   on, they share one of the first len - need + 1; only those are listed.  Values
   that one set alone holds come first in that order and need no list.
3. Each list links its members to its smallest one; the union-sketch estimate
   filters pairs and the exact Jaccard of the full sets confirms them.
   (Step 3 takes both ends of a list, its smallest and its greatest document.)
4. Documents of lists that then still span several components meet across them by
   the rarest items of their full sets.  A pair leaves that join only if three bounds
   allow 0.75: the places of the shared item, the parity bitmaps of the full sets
   (both exact) and the estimate.  So a group of thousands of copies costs its size,
   near copies below the threshold are told apart inside the join, and no link
   between components is lost.

For sets above K shingles ``need`` is statistical: a pair at the threshold misses
it with a chance of about 3e-8.  Smaller sets are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, pin, unwrapped, whole_rows
from .components import components
from .repeats import MAX_ID
from .textnum import Words, grams, mix, span, text_slices, windows, U

SHINGLE = 5
K = 64
#: Shared values of two sketches of K that every pair at 0.75 has, but for a
#: chance of 3e-8 (binomial, K draws at 0.75).
NEED = 28
#: Similarity as a fraction, 75 / 100.
NUM, DEN = 75, 100
#: Bytes of text hashed at once; bounds a worker's memory, not its results.
SLICE = 1 << 19
#: Longs in the parity bitmap of a full set.
LONGS = 16


def _sets(words: Words, size: int):
    """Hash and row of each row's distinct shingles, sorted within the row."""
    pre = words.prefix()
    at, per_row = windows(words.first, size)
    h, row = grams(pre, size)[at] if len(at) else np.zeros(0, np.uint64), np.repeat(np.arange(len(per_row)), per_row)
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    h = np.concatenate([h, span(pre, words.first[short], words.first[short] + words.count[short])]).view(np.int64)
    row = np.concatenate([row, short])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def _lists(h: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(h))


def _sketches(size: int, k: int):
    def run(batches):
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column("text"), SLICE):
                h, row = _sets(Words(buf, off, lower=True), size)
                edges = np.searchsorted(row, np.arange(hi - lo + 1))
                n = np.diff(edges)
                u = h.view(np.uint64)
                sums = [np.zeros(len(h) + 1, np.uint64) for _ in range(2)]
                np.cumsum(mix(u ^ U(0x5851F42D4C957F2D)), out=sums[0][1:])
                np.cumsum(mix(u + U(0x14057B7EF767814F)), out=sums[1][1:])
                s1, s2 = ((s[edges[1:]] - s[edges[:-1]]).view(np.int64) for s in sums)
                low = np.arange(len(h)) - edges[row] < k
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(lo, hi - lo), batch.column("doc_id").slice(lo, hi - lo), pa.array(n),
                     pa.array(s1), pa.array(s2),
                     _lists(h[low], np.searchsorted(row[low], np.arange(hi - lo + 1)))],
                    names=["key", "doc_id", "n", "s1", "s2", "sketch"])
    return run


def _parities(h: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """Per row, whether each bit's count of items is odd.  Two bitmaps differ in at
    most as many bits as the sets differ in items."""
    bit = (h.view(np.uint64) >> U(64 - (64 * LONGS - 1).bit_length())).astype(np.int64)
    odd = np.bincount(row * (64 * LONGS) + bit, minlength=rows * 64 * LONGS).astype(np.uint8) & 1
    packed = np.packbits(odd, bitorder="little").view(np.int64).reshape(rows, LONGS)
    return pa.StructArray.from_arrays([pa.array(packed[:, k]) for k in range(LONGS)], names=[f"l{k}" for k in range(LONGS)])


def _full_sets(size: int):
    def run(batches):
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch.column("text"), SLICE):
                h, row = _sets(Words(buf, off, lower=True), size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("set").slice(lo, hi - lo), _lists(h, np.searchsorted(row, np.arange(hi - lo + 1))),
                     _parities(h, row, hi - lo)], names=["set", "items", "odd"])
    return run


def _need(n: Column) -> Column:
    """Values that the sketches of a set of n and of any similar set share."""
    exact = F.least(F.ceil(n * NUM / DEN), F.lit(K) - F.floor(n / 3))
    return F.when(n <= K, F.greatest(exact, F.lit(1))).otherwise(F.lit(NEED)).cast("int")


def _sizes_fit(a: str, b: str) -> Column:
    return DEN * F.least(a, b) >= NUM * F.greatest(a, b)


def _likely() -> Column:
    """Whether the union-sketch estimate lets a pair (n_a, k_a, n_b, k_b) pass.
    Sketches of small sets are the sets and give the exact value; above, leave
    NEED's margin."""
    union = F.slice(F.array_sort(F.array_union("k_a", "k_b")), 1, K)
    common = F.array_intersect("k_a", "k_b")
    hits, whole = F.size(F.array_intersect(common, union)), F.size(common)
    return F.when((F.col("n_a") > K) | (F.col("n_b") > K), hits >= F.least(F.lit(NEED), _need(F.least("n_a", "n_b")))).otherwise(
        DEN * whole >= NUM * (F.col("n_a") + F.col("n_b") - whole))


def _confirmed(pairs: DataFrame, sets: DataFrame, full: DataFrame) -> DataFrame:
    """Of the candidate pairs (a, b) of sets those that the estimate passes and
    the exact Jaccard confirms."""
    side = lambda c: sets.select(F.col("set").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"k_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    likely_pairs = pin(both.where(_likely()).select("a", "b", "n_a", "n_b"))
    items = lambda c: full.select(F.col("set").alias(c), F.col("items").alias(f"i_{c}"))
    inter = F.size(F.array_intersect("i_a", "i_b"))
    return (likely_pairs.join(items("b"), "b").join(items("a"), "a").withColumn("x", inter)
            .where(DEN * F.col("x") >= NUM * (F.col("n_a") + F.col("n_b") - F.col("x"))).select("a", "b"))


def _reach(most: Column) -> Column:
    """Whether ``most`` shared items are enough for the sizes n_a and n_b."""
    return (DEN + NUM) * most >= NUM * (F.col("n_a") + F.col("n_b"))


def _across(rest: DataFrame, sets: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs of sets of different components that may be similar.

    Items are ordered from the rarest on.  If the first that two sets share has p
    items before it in a set of n, they share at most n - p; so it is among the
    first n - 6/7 n + 1 of the smaller set (the pair needs 3/7 of both sizes) and
    the first n - 3/4 n + 1 of the greater, and the join compares the rest for the
    sizes at hand.  Then the parity bitmaps bound the difference of the sets.  Both
    are exact.  The estimate comes last, so the join puts out only likely pairs."""
    items = full.join(rest, "set").select("set", "n", "c", F.explode("items").alias("item"))
    shared = pin(items.groupBy("item").agg(F.count(F.lit(1)).alias("df"), (F.min("c") != F.max("c")).alias("open")).where("df > 1"))
    ranked = (items.join(shared, "item").groupBy("set", "n", "c")
              .agg(F.sort_array(F.collect_list(F.struct("df", "item", "open"))).alias("vs")))
    # items of one set alone come first, so the k-th of vs (from 0) leaves size(vs) - k items
    kept = (F.size("vs") - F.ceil(F.col("n") * NUM / DEN) + 1).cast("int")
    lists = pin(ranked.withColumn("m", F.size("vs")).withColumn("kept", kept).where("kept > 0")
                .select("set", "n", "c", "m", F.posexplode(F.slice("vs", F.lit(1), F.col("kept"))).alias("k", "e")).where("e.open")
                .select("e.item", "set", "n", "c", (F.col("m") - F.col("k")).alias("left")))
    spread = lists.groupBy("item").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("item")
    met = lists.join(pin(spread), "item").join(sets.select("set", "sketch"), "set").join(full.select("set", "odd"), "set")
    side = lambda x: met.select("item", F.col("set").alias(x), F.col("c").alias(f"c_{x}"), F.col("n").alias(f"n_{x}"),
                                F.col("left").alias(f"left_{x}"), F.col("odd").alias(f"odd_{x}"), F.col("sketch").alias(f"k_{x}"))
    small = side("a").where((DEN + NUM) * F.col("left_a") >= 2 * NUM * F.col("n_a"))
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    fits = ordered & (F.col("c_a") != F.col("c_b")) & _sizes_fit("n_a", "n_b") & _reach(F.least("left_a", "left_b"))
    differ = F.bit_count(F.col("odd_a.l0").bitwiseXOR(F.col("odd_b.l0")))
    for i in range(1, LONGS):
        differ += F.bit_count(F.col(f"odd_a.l{i}").bitwiseXOR(F.col(f"odd_b.l{i}")))
    # sets that differ in d items share (n_a + n_b - d) / 2
    near = (DEN + NUM) * (F.col("n_a") + F.col("n_b") - differ) >= 2 * NUM * (F.col("n_a") + F.col("n_b"))
    test = F.when(fits, F.when(near, _likely()).otherwise(F.lit(False))).otherwise(F.lit(False))
    return small.join(side("b"), "item").where(test).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_documents(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per document: key, doc_id, n_shingles, component_id.

    Null, empty and blank texts have no shingles and are linked with nothing;
    texts of fewer words have one shingle, the whole sequence; equal sets share a
    component.  Rows of one doc_id (null: one unknown id) are one document for
    the linking.  An empty table gives an empty result."""
    base = keyed(docs)
    sigs = pin(base.mapInArrow(_sketches(size, K), "key long, doc_id long, n long, s1 long, s2 long, sketch array<long>"))
    some = sigs.where("n > 0")
    sets = pin(some.groupBy("s1", "s2", "n").agg(
        F.min(F.struct(F.coalesce("doc_id", F.lit(MAX_ID)).alias("node"), "key")).alias("rep"), F.first("sketch").alias("sketch"))
        .select(F.xxhash64("s1", "s2", "n").alias("set"), "n", "rep.node", "rep.key", "sketch"))
    # inverted lists over the values that need one
    posts = sets.select("set", F.explode("sketch").alias("v"))
    shared = pin(posts.groupBy("v").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    ranked = (posts.join(shared, "v").groupBy("set").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs")))
    kept = F.size("sketch") - _need(F.col("n")) + 1 - (F.size("sketch") - F.size("vs"))
    lists = pin(sets.join(ranked, "set").withColumn("kept", kept).where("kept > 0")
                .select("set", "n", "node", "key", F.explode(F.slice("vs", F.lit(1), F.col("kept"))).alias("e"))
                .select("set", "n", "node", "key", "e.v"))
    entry = F.struct("node", "set", "n")
    heads = pin(lists.groupBy("v").agg(F.min(entry).alias("lo"), F.max(entry).alias("hi"), F.count(F.lit(1)).alias("k"))
                .where("k > 1").select("v", "lo", "hi"))
    # full sets of the documents that meet another in some list
    asked = lists.join(heads, "v").select("set", "key").distinct()
    full = pin(base.select("key", "text").join(asked, "key").dropDuplicates(["set"]).select("set", "text")
               .mapInArrow(_full_sets(size), f"set long, items array<long>, odd struct<{', '.join(f'l{k}: long' for k in range(LONGS))}>"))
    ends = lists.join(heads, "v").select("set", "n", F.explode(F.array("lo", "hi")).alias("h"))
    first = pin(ends.where((F.col("set") != F.col("h.set")) & _sizes_fit("n", "h.n"))
                .select(F.col("h.set").alias("a"), F.col("set").alias("b")).distinct())
    nodes = sets.select("set", "node")
    as_nodes = lambda links: (links.join(nodes.withColumnsRenamed({"set": "a", "node": "x"}), "a")
                              .join(nodes.withColumnsRenamed({"set": "b", "node": "y"}), "b").select("x", "y"))
    links = pin(as_nodes(_confirmed(first, sets, full)))
    found = components(links)
    # documents of lists that still span components meet again by their full sets
    labelled = lists.join(found, "node", "left").withColumn("c", F.coalesce("component", "node")).select("v", "set", "n", "c")
    open_lists = pin(labelled.groupBy("v").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("v"))
    rest = labelled.join(open_lists, "v").select("set", "n", "c").distinct()
    across = _across(rest, sets, full)
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = as_nodes(_confirmed(pin(across.join(tried, ["a", "b"], "left_anti")), sets, full))
    every = components(links.unionByName(more))
    owner = (sets.select("set", "node").join(every, "node", "left")
             .select("set", F.coalesce("component", "node").alias("component")))
    tagged = sigs.select("key", "doc_id", "n", F.when(F.col("n") > 0, F.xxhash64("s1", "s2", "n")).alias("set"))
    return (tagged.join(pin(owner), "set", "left")
            .select("key", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def decisions(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return link_documents(docs, size).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each group of near copies (the smallest doc_id); columns
    as they came.  Documents without shingles stay."""
    gone = pin(link_documents(docs, size).where("doc_id <> component_id").select("key").distinct())
    return unwrapped(whole_rows(docs).join(gone, "key", "left_anti"), docs.columns)
