"""Exact dedup behind a two-pass Bloom filter, with DataFrame functions only.

Pass one counts hash slots (two per row, both in the one block that the row's hash
names) and keeps, as bitmaps, the slots that two rows or more have hit.  Pass two
probes position and hash of each row, nothing else: a row both of whose slots are in
the filter is possibly repeated, and the positions of such rows come back as bitmaps.
Only those rows go to a shuffle, by id, length and full SHA-256; all others are
certainly unique and pass straight through.  No text is shuffled at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, pin

#: Slots of the filter for each row; two hashes give about 1.4 % false hits.
SLOTS_PER_ROW = 16
#: Bitmaps of positions are broadcast in slices of at most this size (one block at
#: least), each to the rows of its range.  More rows make more slices, not larger ones.
BROADCAST_BYTES = 32 << 20
_SHIFT = 15
_BLOCK = 1 << _SHIFT  # bits of a bitmap block


def normalised(text: Column) -> Column:
    """Text without ASCII white space; null is empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACES, "")


def _blocks(bits: DataFrame) -> DataFrame:
    """One bitmap for each ``block`` of the numbers in ``bit`` (0 to 32,767).  Rows meet
    before they become bitmaps: at most one row per bit, and no bitmap per task."""
    return pin(bits.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def _is_set(bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def _possible(rows: DataFrame) -> DataFrame:
    """Positions (``row``) of the rows that are possibly repeated, as bitmaps by block;
    ``rows`` is a written table with ``row`` and the hash ``h``."""
    rows = rows.select("row", "h")
    n = max(1, -(-rows.count() * SLOTS_PER_ROW // _BLOCK))
    rows = rows.select("row", F.pmod("h", F.lit(n)).alias("block"), *[
        F.pmod(F.xxhash64("h", F.lit(name)), F.lit(_BLOCK)).alias(name) for name in ("first", "second")])
    twice = (rows.select("block", F.explode(F.array("first", "second")).alias("bit"))
             .groupBy("block", "bit").count().where("count > 1"))
    hit = (rows.join(_blocks(twice.select("block", "bit")), "block")
           .where(_is_set(F.col("first")) & _is_set(F.col("second"))))
    return _positions(hit)


def _positions(rows: DataFrame) -> DataFrame:
    """Bitmaps of the positions ``row``."""
    return _blocks(rows.select(F.shiftright("row", _SHIFT).alias("block"), (F.col("row") % _BLOCK).alias("bit")))


def _marked(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds ``marked``: the row's position is in ``marks``.  The bitmaps are broadcast by
    ranges of positions, twice as many as their size asks for, so that approximate cuts
    keep each within the bound; a scan of a range skips the other row groups."""
    slices = -(-marks.count() // max(1, 8 * BROADCAST_BYTES // _BLOCK))
    cuts = []
    if slices > 1:
        parts = 2 * slices
        cuts = sorted(set(marks.agg(F.percentile_approx("block", [i / parts for i in range(1, parts)], 4 * parts)
                                    .alias("cuts")).first().cuts))
    out = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        part, bits = rows, marks
        if low is not None:
            part, bits = part.where(F.col("row") >= low * _BLOCK), bits.where(F.col("block") >= low)
        if high is not None:
            part, bits = part.where(F.col("row") < high * _BLOCK), bits.where(F.col("block") < high)
        part = (part.withColumn("block", F.shiftright("row", _SHIFT)).join(F.broadcast(bits), "block", "left")
                .withColumn("marked", _is_set(F.col("row") % _BLOCK)).drop("block", "bits"))
        out = part if out is None else out.unionByName(part)
    return out


def _order() -> Column:
    """Of equal texts the greatest stays: most code points, smallest doc_id (null
    last), then the first of rows that agree in both."""
    return F.struct("chars", (-F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("neg"), (-F.col("row")).alias("neg_row"),
                    "doc_id")


def _groups(maybe: DataFrame) -> DataFrame:
    return pin(maybe.groupBy("text_sha256").agg(F.max(_order()).alias("best"), F.count(F.lit(1)).alias("group_size")))


def decisions(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null and empty texts are equal to each other and to texts of white space
    only.  Of rows that agree in id and text one stays.  An empty table gives an
    empty result; other columns are not read."""
    norm = normalised(F.col("text"))
    rows = pin(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("chars"),
        F.xxhash64(norm).alias("h"), F.sha2(norm, 256).alias("text_sha256"))
        .withColumn("row", F.monotonically_increasing_id()))
    rows = _marked(rows, _possible(rows))
    maybe = rows.where("marked")
    repeated = (maybe.join(_groups(maybe), "text_sha256")
                .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                        (F.col("best.neg_row") == -F.col("row")).alias("kept"), "text_sha256"))
    alone = rows.where("not marked").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                            F.lit(True).alias("kept"), "text_sha256")
    return alone.unionByName(repeated)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The documents without later copies; columns as they came.  The rows are written
    once with their positions and read back without the positions that lost; possibly
    repeated ones meet by hash, without their texts.  Null texts count as empty and
    equal; of equal rows one stays, a null doc_id counts as larger than any; an empty
    table gives an empty result; further columns of any name come back as they were."""
    rows = pin(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
                           F.xxhash64(normalised(F.col("text"))).alias("h"))
               .withColumn("row", F.monotonically_increasing_id()), "zstd")
    text = F.coalesce(F.col("_doc.text").cast("string"), F.lit(""))
    maybe = pin(_marked(rows, _possible(rows)).where("marked").select(
        "row", F.sha2(normalised(text), 256).alias("text_sha256"), F.col("_doc.doc_id").cast("long").alias("doc_id"),
        F.length(text).alias("chars")))
    lost = maybe.join(_groups(maybe), "text_sha256").where(F.col("best.neg_row") != -F.col("row"))
    return _marked(rows, _positions(lost)).where("not marked").select("_doc.*")
