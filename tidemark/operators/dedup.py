"""One row per hash or key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL_ORDER = ("created_at", "source", "metadata_row_number")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark cuts each key to one row per map task before the shuffle, so many copies of one row never
    meet in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def first_per_hash(df: DataFrame, order: Sequence[str] = ARRIVAL_ORDER, hash_column: str = "md5") -> DataFrame:
    """Drops re-delivered records; the earliest arrival survives."""
    return first_per_key(df, [hash_column], order)


def newest_per_key(df: DataFrame, key: str, *times: str) -> DataFrame:
    """The last state of each key within a batch: newest time first, all other columns break ties."""
    rest = [c for c in df.columns if c != key and c not in times]
    order = [F.col(c).desc_nulls_last() for c in (*times, *rest)]
    return first_per_key(df, [key], order)
