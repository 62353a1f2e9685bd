"""Session settings and the shared folder that runs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Beyond 2,000 reducers a map task reports only the average block size, which hides a hot
    # block from the skew-join rule. Blocks over five times the median are reported exactly.
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    # Bronze records are written as typed columns of their fields, and a query reads the fields that it names.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the library's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """Number of partitions a shuffle of this session is planned with."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plan_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan, the one its broadcast decision rests on."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder, since every
    executor of a cluster must see the same files.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="tidemark-")
        base = _local_scratch.name
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")
