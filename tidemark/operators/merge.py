"""Merges by key, for tables that have no MERGE statement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join


def close_versions(table: DataFrame, batch: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """Every version whose key the batch delivers is no longer effective.

    ``unique`` says that the table holds one row per key, as an effective slice does. Otherwise one
    key may own many of its versions, and the join guards against that.
    """
    delivered = batch.select(F.col(key).alias("_key")).distinct().withColumn("_delivered", F.lit(True))
    if unique:
        marked = table.join(delivered, F.col(key) == F.col("_key"), "left")
    else:
        marked = lookup_join(table, delivered, key, "_key")
    still = F.col("is_effective") & F.col("_delivered").isNull()
    return marked.withColumn("is_effective", still).select(*table.columns)


def untouched(table: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored rows whose key the batch does not deliver; the table holds one row per key."""
    keys = batch.select(F.col(key).alias("_key")).distinct()
    return table.join(keys, F.col(key) == F.col("_key"), "left_anti")


def upsert(table: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Matched rows are overwritten in every column, the others inserted; one batch row per key."""
    return untouched(table, batch, key).unionByName(batch.select(*table.columns))


def unmatched(batch: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Batch rows whose key the table does not hold in any version."""
    keys = table.select(F.col(key).alias("_key")).distinct()
    return batch.join(keys, F.col(key) == F.col("_key"), "left_anti")


def close_or_insert(table: DataFrame, versions: DataFrame, key: str) -> DataFrame:
    """Matched keys are closed; a key the table never held is inserted."""
    first_versions = unmatched(versions, table, key)
    return close_versions(table, versions, key).unionByName(first_versions.select(*table.columns))
