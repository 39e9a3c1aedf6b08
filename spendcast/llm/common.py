"""Helpers shared by the operators: lineage cuts, row hygiene, partition counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendcast.session import ensure_checkpoint_dir

#: ASCII white space as the contracts write it, ``[\x20\x09-\x0D]``.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a (Java) regular expression.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def pin(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: cuts the lineage, survives executor loss, keeps column pruning."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/pin-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the deployment sizes them to its input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns every document operator needs: ``doc_id`` as long and
    ``text`` as string with null read as the empty text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """``id_text`` plus ``key``, a 64-bit hash of both columns.  Rows that agree
    in both are the same document and get the same result; rows that share only
    the id stay apart."""
    base = id_text(docs)
    return base.select(F.xxhash64(F.lit("doc"), "doc_id", "text").alias("key"), "doc_id", "text")


def whole_rows(docs: DataFrame) -> DataFrame:
    """``row``, every row as one struct, so that no further column's name can clash, and
    its ``key`` as in ``keyed``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return rows.withColumn("key", F.xxhash64(F.lit("doc"), F.col("row.doc_id").cast("long"), text))


def unwrapped(rows: DataFrame, columns: list[str], new: dict | None = None) -> DataFrame:
    """The columns of ``row``, those in ``new`` replaced."""
    return rows.select(*[((new or {}).get(c, F.col(f"row.`{c}`"))).alias(c) for c in columns])


def held_out() -> "F.Column":
    """The fold no label is learned from: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
