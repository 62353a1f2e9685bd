"""Consume-once deltas of bronze: a checkpoint per consumer remembers what it has taken."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.streaming.bronze import ANY_AGE, BRONZE_SCHEMA


def consume(
    spark: SparkSession,
    bronze: str,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    max_files: int | None = None,
    columns: Sequence[Column] | None = None,
) -> None:
    """Calls ``apply(rows, batch)`` on every batch of unread bronze rows.

    ``columns`` are taken out by the stream itself, whose scan then reads the fields that they name; a batch is handed on as
    rows, of which a later projection can only read whole records.

    The position moves on only after ``apply`` returns, so a failed batch is delivered again under
    the same number. ``apply`` must therefore write by that number: overwrite a folder named after
    it, or commit it as a batch id.
    """
    reader = spark.readStream.schema(BRONZE_SCHEMA).option("maxFileAge", ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(bronze)
    query = (
        (rows if columns is None else rows.select(*columns))
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def take_current(spark: SparkSession, bronze: str, current: str, checkpoint: str, max_files: int | None = None) -> None:
    """Moves the unread rows of bronze into the current table, one folder per batch."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{current}/batch_id={batch}")

    consume(spark, bronze, checkpoint, write, max_files)
