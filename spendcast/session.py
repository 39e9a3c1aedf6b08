"""Session construction and checkpoint-directory policy."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours uses; a cluster deployment passes its own
# values for the rest (memory, partitions, checkpoint dir).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints written by the skew-safe scan are dropped once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # the 124-column feature aggregate stays inside whole-stage codegen
    "spark.sql.codegen.maxFields": "400",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "spendcast", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench (single JVM, no UI)."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.default.parallelism", str(shuffle_partitions))
               .config("spark.driver.memory", "12g")
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.driver.bindAddress", "127.0.0.1"))
    for key, value in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster the directory must come from ``spark.checkpoint.dir`` (a
    shared file system).  Only a local-mode session without one gets a fresh
    temporary directory, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss")
    path = tempfile.mkdtemp(prefix="spendcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def pin(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it
    back: cuts the lineage, survives executor loss, and later reads take only the
    columns they use (a checkpoint's rows are read whole)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/pin-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)
