"""Continuous load of landed files into bronze: each file once, each row with its lineage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.clock import ntz
from tidemark.functions.hashing import record_hash
from tidemark.functions.schemas import struct
from tidemark.functions.variants import whole_record

BRONZE_SCHEMA = struct(
    {
        "parquet_raw": "variant",
        "md5": "string",
        "created_at": "timestamp_ntz",
        "source": "string",
        "metadata_row_number": "bigint",
    }
)


# A consumer may take one file at a time, and reads it by row groups.
GROUP_BYTES, GROUP_SETTING = 8 * 1024 * 1024, "parquet.block.size"
# By default a file stream passes over files a week older than the newest one: restored or copied ones would be lost.
ANY_AGE = "36500d"


def bronze_rows(files: DataFrame, loaded_at: datetime | str) -> DataFrame:
    """The record as one object, its hash, the load time, and the file and row it came from."""
    columns = files.columns
    return files.select(
        whole_record(columns).alias("parquet_raw"),
        record_hash(columns).alias("md5"),
        ntz(loaded_at).alias("created_at"),
        F.col("_metadata.file_path").alias("source"),
        (F.col("_metadata.row_index") + 1).alias("metadata_row_number"),
    )


def start_bronze(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    bronze: str,
    checkpoint: str,
    loaded_at: datetime | str,
    max_files: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Starts the pipe of one entity: all waiting files and an end, or for ever with ``every``."""
    reader = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFileAge", ANY_AGE)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    writer = (
        bronze_rows(reader.parquet(landing), loaded_at)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    # A file sink has no options of its writer; it takes them from the session when it starts.
    before = spark.conf.get(GROUP_SETTING, None)
    spark.conf.set(GROUP_SETTING, GROUP_BYTES)
    try:
        return writer.start(bronze)
    finally:
        if before is None:
            spark.conf.unset(GROUP_SETTING)
        else:
            spark.conf.set(GROUP_SETTING, before)


def load_bronze(*args, **kwargs) -> None:
    """Loads every file that has not been loaded yet, then returns."""
    start_bronze(*args, **kwargs).awaitTermination()


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    return spark.read.schema(BRONZE_SCHEMA).parquet(bronze)
