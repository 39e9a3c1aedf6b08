"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage works on all that its predecessor kept, written as Parquet and read
again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendcast.llm import exact_dedup as exact
from spendcast.llm import near_dedup as near
from spendcast.llm import packing, quality_crf
from spendcast.llm import substring_dedup as substring
from spendcast.llm.common import pin


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the line classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_crf.keep_good(docs, quality_crf.train(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of equal texts."""
    return exact.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near.near_dedup(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later copies of repeated passages out of the texts."""
    return substring.substring_dedup(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences; one row per piece."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("substring_dedup", substring_dedup), ("best_fit_packing", pack)]

#: The classifier and the tokenizer have no SQL form; tests compare the stages
#: with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = pin(docs, "zstd")
    return docs
