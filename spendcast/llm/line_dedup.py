"""Line dedup: lines that many documents share stay in one of them.

1. Every row sends one record for each of its long enough line keys: a 128-bit digest,
   its doc_id, a hash of the row, and the places of the lines (so a line that a document
   repeats costs one record).
2. Records are range-partitioned by (digest, doc_id), so a line that a third of the
   documents hold spans many partitions, and sorted by digest, document (greatest first)
   and row within each.
3. A partition streams its records once.  The first document of a digest keeps its
   lines, those of later ones go as soon as a third document (``documents``) has come;
   until then they are held, a bounded number of them.  A digest at a partition's edge
   may go on in the next one: its records leave undecided, with one summary (how many
   documents, the greatest) for each partition; at most two digests of a partition are
   open, so the summaries' totals are bounded by the number of partitions.
4. What comes back to the documents are the places to drop, as a compressed bitmap for
   each row that loses lines; texts are never sent with the records.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, pin

LEAST_POINTS = 20
DOCUMENTS = 3
_ROWS = 256  # texts turned into Python objects at once
_HELD = 4096  # records held until a digest is decided; more leave undecided
_SEEN = 1 << 18  # row hashes that a task remembers, to skip repeated rows
_FIRST = -(1 << 63)  # stands for a missing doc_id: smaller than all others

_RECORD = "h long, g long, doc_id long, key long, places binary"
_FOUND = "h long, g long, doc_id long, key long, places binary, docs long, state int"
DROP, OPEN, SUMMARY = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """ASCII white space off both ends, A-Z lower-cased (methods of bytes touch ASCII only)."""
    return line.strip().lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or sum(b & 0xC0 != 0x80 for b in key) >= least)


def _records(least: int):
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                some = batch.slice(lo, _ROWS)
                digests, docs, keys, places = [], [], [], []
                for key, doc, text in zip(some.column("key").to_pylist(), some.column("doc_id").to_pylist(),
                                          some.column("text").cast(pa.large_binary()).to_pylist()):
                    if key in seen:
                        continue
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(key)
                    found: dict[bytes, list[int]] = {}
                    for i, line in enumerate(text.split(b"\n")):
                        if len(line) >= least and _long_enough(k := line_key(line), least):
                            found.setdefault(k, []).append(i)
                    for k, at in found.items():
                        digests.append(hashlib.blake2b(k, digest_size=16).digest())
                        docs.append(_FIRST if doc is None else doc)
                        keys.append(key)
                        places.append(np.array(at, "<u4").tobytes())
                d = np.frombuffer(b"".join(digests), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d[::2].copy()), pa.array(d[1::2].copy()), pa.array(docs, pa.int64()), pa.array(keys, pa.int64()), pa.array(places, pa.binary())],
                    names=["h", "g", "doc_id", "key", "places"])
    return run


def _decide(documents: int):
    """Streams a sorted partition; see step 3 above."""
    schema = pa.schema([(c, pa.binary() if c == "places" else pa.int32() if c == "state" else pa.int64())
                        for c in ("h", "g", "doc_id", "key", "places", "docs", "state")])

    def run(batches):
        out: list[tuple] = []
        digest, opened = None, True  # the partition's first digest may have begun before it
        greatest = last = None  # documents of the digest
        docs, held = 0, []

        def leave(state):
            out.extend((*r, 0, state) for r in held)
            held.clear()

        def close(edge):
            """The digest has ended, or the partition has (``edge``)."""
            if digest is None:
                return
            if opened or edge:
                leave(OPEN)
                out.append((*digest, greatest, None, None, docs, SUMMARY))
            held.clear()

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("h", "g", "doc_id", "key", "places")]
            for r in zip(*cols):
                if digest != r[:2]:
                    close(False)
                    opened = digest is None
                    digest, greatest, last, docs = r[:2], r[2], None, 0
                if r[2] != last:
                    last, docs = r[2], docs + 1
                    if docs == documents and not opened:
                        leave(DROP)
                if opened:
                    out.append((*r, 0, OPEN))
                elif docs >= documents:
                    out.append((*r, 0, DROP))
                elif r[2] != greatest:
                    held.append(r)
                    if len(held) > _HELD:
                        leave(OPEN)
                        opened = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out.clear()
        close(True)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    return run


def dropped_places(docs: DataFrame, least: int = LEAST_POINTS, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id (``_FIRST`` for null), key (``common.keyed``), places: lines to drop, as
    little-endian unsigned 32-bit numbers from 0; several rows for a document."""
    records = pin(keyed(docs).select("key", "doc_id", "text").mapInArrow(_records(least), _RECORD))
    order = [F.col("h"), F.col("g"), F.col("doc_id").desc()]
    # a document's records of a digest are never parted, so the counts of documents add up
    found = pin(records.repartitionByRange(*order).sortWithinPartitions(*order, "key").mapInArrow(_decide(documents), _FOUND))
    totals = pin(found.where(F.col("state") == SUMMARY).groupBy("h", "g")
                 .agg(F.sum("docs").alias("documents"), F.max("doc_id").alias("greatest")).where(F.col("documents") >= documents))
    later = (found.where(F.col("state") == OPEN).join(totals.select("h", "g", "greatest"), ["h", "g"])
             .where("doc_id <> greatest").select("doc_id", "key", "places"))
    return found.where(F.col("state") == DROP).select("doc_id", "key", "places").unionByName(later)


def _bitmap(batches):
    for batch in batches:
        keep = []
        for parts in batch.column("parts").to_pylist():
            at = np.frombuffer(b"".join(parts), "<u4")
            bits = np.ones(int(at.max()) // 8 * 8 + 8, np.uint8)
            bits[at] = 0
            keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(keep, pa.binary())], names=["doc_id", "key", "keep"])


def keep_bitmaps(docs: DataFrame, least: int = LEAST_POINTS, documents: int = DOCUMENTS) -> DataFrame:
    """One row for each row of ``docs`` that loses lines (equal rows: one): doc_id (the
    least long for null), key (``common.keyed``), keep: zlib-compressed bits, one for
    each line up to the last dropped one and some further ones, lowest bit first, 1 to
    keep; all later lines stay.

    A line goes if its key (``line_key``) has ``least`` code points or more, is in
    ``documents`` documents or more and the row's doc_id is not the greatest of them.
    Rows of one doc_id, and all rows without one (the least), are one document.  Null
    and empty texts have one empty line.  An empty table gives an empty result."""
    places = dropped_places(docs, least, documents)
    return places.groupBy("doc_id", "key").agg(F.collect_list("places").alias("parts")).mapInArrow(
        _bitmap, "doc_id long, key long, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> tuple[list[bytes], int]:
    """Lines that a bitmap keeps, and how many there were."""
    lines = text.split(b"\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[:len(lines)]
    return [x for x, k in zip(lines, bits.tolist()) if k] + lines[len(bits):], len(lines)


def _with_bitmaps(docs: DataFrame, least: int, documents: int) -> DataFrame:
    """doc_id, text and whole row of every row, with its bitmap (or null)."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    base = row.select(F.col("row.doc_id").cast("long").alias("id"), F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"), "row")
    base = base.withColumn("key", F.xxhash64(F.lit("doc"), "id", "text")).withColumn("doc_id", F.coalesce("id", F.lit(_FIRST)))
    return base.join(pin(keep_bitmaps(docs, least, documents)), ["doc_id", "key"], "left")


def digests(docs: DataFrame, least: int = LEAST_POINTS, documents: int = DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines (before), n_dropped, kept_sha256 (of
    the lines that stay, joined by line feeds).  Edge cases as in ``keep_bitmaps``."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                some = batch.slice(lo, _ROWS)
                out = []
                for text, keep in zip(some.column("text").cast(pa.large_binary()).to_pylist(), some.column("keep").to_pylist()):
                    lines, n = kept_lines(text, keep)
                    out.append((n, n - len(lines), hashlib.sha256(b"\n".join(lines)).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id")] + [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
                    names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return _with_bitmaps(docs, least, documents).select("id", "text", "keep").mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def line_dedup(docs: DataFrame, least: int = LEAST_POINTS, documents: int = DOCUMENTS) -> DataFrame:
    """``docs`` with the lines dropped from ``text`` (and ``n_chars`` counted anew, if
    there is such a column); other columns and their names as they came.  Edge cases as
    in ``keep_bitmaps``; rows that lose nothing keep their text, null too."""
    @F.pandas_udf("string")
    def cut(text, keep):
        return text.combine(keep, lambda t, k: None if k is None else b"\n".join(kept_lines(t.encode(), k)[0]).decode())

    joined = _with_bitmaps(docs, least, documents)
    new = joined.select("row", F.when(F.col("keep").isNotNull(), cut("text", "keep")).alias("cut"))
    text = F.coalesce("cut", F.col("row.text").cast("string"))
    columns = {"text": text, **({"n_chars": F.when(F.col("cut").isNotNull(), F.char_length("cut")).otherwise(F.col("row.n_chars")).cast(
        docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})}
    return new.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
