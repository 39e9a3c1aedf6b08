"""Filter interaction audit: what each filter removes, in every order of the filters.

Every document gets a mask of the filters that it fails; all figures follow from the
counts of masks.  A coalition S of filters removes v(S), the documents whose mask
meets S.  The Hart-Mas-Colell potential of the removal game is

    P(empty) = 0,    P(S) = (v(S) + sum of P(S without i) over i in S) / |S|,

and a filter's Shapley value is P(all) - P(all without it).  Differences of
coalitions give the steps of an order: the filter at a step removes
v(before and it) - v(before).  Texts are only compared through 128-bit digests: the
first document of a text comes from a grouped minimum, which tasks combine before the
shuffle, and a document finds out whether it is that one by a join on digest *and*
doc_id, so a text that a third of the documents share gathers nowhere.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pin

FILTERS = "ABCDE"
#: Fixed values of the filters' definitions.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
_CAPITALS, _SIGNS = bytes(range(65, 91)), b"#$%&*|"
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes of a character after its first
_ROWS = 256  # texts turned into Python objects at once


def _fails(text: bytes) -> int:
    """Bits 0 to 3: the text's failures of filters A to D."""
    words = text.split()  # of bytes: at ASCII white space only
    points = len(text.translate(None, _CONTINUED))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, _CAPITALS))) > CAPITAL_PERCENT * points) << 2
            | (len(text.translate(None, _SIGNS)) < len(text)) << 3)


def _facts(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            some = batch.slice(lo, _ROWS)
            texts = some.column("text").cast(pa.large_binary()).to_pylist()
            digest = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), np.int64)
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), some.column("part"), pa.array(digest[::2].copy()), pa.array(digest[1::2].copy()),
                 pa.array([_fails(t) for t in texts], pa.int32())], names=["doc_id", "part", "h", "g", "mask"])


def document_masks(docs: DataFrame) -> DataFrame:
    """Groups of alike rows: doc_id, part (the source), mask (bit k: fails filter k of
    ``FILTERS``), n rows.

    Null texts count as empty, a null source as the empty string.  A row without
    doc_id is no smaller and no greater than others: it never fails E and makes no
    other row fail it.  Rows of one doc_id and one text do not fail E for each other.
    An empty table gives an empty result; other columns are not read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    facts = pin(rows.mapInArrow(_facts, "doc_id long, part string, h long, g long, mask int"))
    alike = facts.groupBy("doc_id", "h", "g", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    firsts = (facts.where(F.col("doc_id").isNotNull()).groupBy("h", "g").agg(F.min("doc_id").alias("doc_id"))
              .withColumn("first", F.lit(0)))
    later = F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("first", F.lit(1)))
    return (alike.join(firsts, ["h", "g", "doc_id"], "left")
            .select("doc_id", "part", (F.col("mask") + 16 * later).alias("mask"), "n"))


def _game(size: int) -> list[list[tuple[str, str]]]:
    """SQL of the potentials, times lcm(1..size) so that all are whole numbers, by
    size of the coalition: ``p<S>`` for every set S of filters (as bits), from ``v``."""
    unit = math.lcm(*range(1, size + 1))
    sets = sorted(range(1, 1 << size), key=lambda s: (s.bit_count(), s))
    return [[(f"p{s}", f"({unit} * v[{s}] + " + " + ".join(f"p{s & ~(1 << i)}" for i in range(size) if s >> i & 1) + f") div {k}")
             for s in sets if s.bit_count() == k] for k in range(1, size + 1)]


def audit(counts: DataFrame, filters: Sequence[str] = FILTERS, lost: Sequence[str] = ()) -> DataFrame:
    """``counts``: part, mask, n and the columns of ``lost`` (counts of documents of some
    kind), any number of rows for a part and mask.  One row for each part, order of the
    filters and step: filter_order, step (from 1), kept, removed, redundant (failing the
    step's filter, removed earlier), unique_fails, shapley (the filter's removals summed
    over all orders) and ``<x>_lost`` for every x of ``lost``.

    The orders are size! in number, so this is for a handful of filters.  A part
    without documents has no rows; an empty table gives an empty result."""
    size = len(filters)
    whole, orders = (1 << size) - 1, list(permutations(range(size)))
    by_mask = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", *lost)])

    def coalitions(c: str) -> Column:
        meets = ", ".join(f"sum(if(mask & {s} <> 0, {c}, 0L))" for s in range(1, 1 << size))
        return F.expr(f"array(0L, {meets})")

    game = by_mask.groupBy("part").agg(F.sum("n").alias("all"), coalitions("n").alias("v"), *[coalitions(c).alias(f"v_{c}") for c in lost])
    game = game.withColumn("p0", F.lit(0).cast("long"))
    for level in _game(size):
        game = game.withColumns({name: F.expr(sql) for name, sql in level})
    # lcm(1..size) divides size!; the sum over all orders is size! Shapley values
    times = math.factorial(size) // math.lcm(*range(1, size + 1))
    game = game.select("part", "all", "v", *[f"v_{c}" for c in lost],
                       F.array(*[times * (F.col(f"p{whole}") - F.col(f"p{whole & ~(1 << i)}")) for i in range(size)]).alias("shapley"))
    steps = [("".join(filters[i] for i in o), k + 1, o[k], 1 << o[k], sum(1 << i for i in o[:k])) for o in orders for k in range(size)]
    names = ("filter_order", "step", "i", "bit", "before")
    table = F.from_json(F.lit(json.dumps([dict(zip(names, s)) for s in steps])),
                        "array<struct<filter_order string, step int, i int, bit int, before int>>")
    rows = game.select("*", F.explode(table).alias("s")).select("*", "s.*")
    bit = F.col("bit")
    at = lambda v, s: F.get(F.col(v), s)
    gain = lambda v: at(v, F.col("before") + bit) - at(v, F.col("before"))
    return rows.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        (F.col("all") - at("v", F.col("before") + bit)).alias("kept"), gain("v").alias("removed"),
        (at("v", bit) - gain("v")).alias("redundant"), (at("v", F.lit(whole)) - at("v", F.lit(whole) - bit)).alias("unique_fails"),
        *[gain(f"v_{c}").alias(f"{c}_lost") for c in lost], F.get(F.col("shapley"), F.col("i")).alias("shapley"))


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters over the documents, with good_lost and toxic_lost
    (``labels``: doc_id, quality, toxic; several labels of one document count once, by
    the greatest; documents without a label are neither)."""
    masks = pin(document_masks(docs))
    marks = pin(labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(x) for c, x in (("quality", "good"), ("toxic", "toxic"))]))
    zero = F.lit(0).cast("long")
    marked = (masks.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left")
              .select("part", "mask", "n", *[(F.col("n") * F.coalesce(x, zero)).alias(x) for x in ("good", "toxic")]))
    nameless = masks.where(F.col("doc_id").isNull()).select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    return audit(marked.unionByName(nameless), FILTERS, ("good", "toxic"))
