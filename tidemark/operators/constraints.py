"""Primary and foreign keys as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, and NULL keys; counts are combined before the shuffle."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return counted.where((F.col("copies") > 1) | F.col(key).isNull())


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key no parent row has. A NULL foreign key breaks no constraint."""
    keyed = child.where(F.col(foreign_key).isNotNull())
    parents = parent.select(F.col(parent_key).alias("_parent_key"))
    return lookup_join(keyed, parents, foreign_key, "_parent_key", how="left_anti")
