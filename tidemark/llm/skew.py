"""Joins of rows to an aggregate over them, where one key may hold a large part of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_aggregate(rows: DataFrame, aggregate: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to an ``aggregate`` that is grouped by the long columns ``keys``.

    An aggregate lies dealt by its keys already, so Spark would join it in the stage that finishes it, and there
    adaptive execution cannot split a hot key. Joined on the complements of the keys, both sides are dealt for the join
    itself, and a partition with a hot key is read by several tasks.
    """
    others = [c for c in aggregate.columns if c not in keys]
    right = aggregate.select(*(F.bitwise_not(k).alias(f"__not_{k}") for k in keys), *others)
    on = reduce(lambda a, b: a & b, (F.bitwise_not(rows[k]) == right[f"__not_{k}"] for k in keys))
    return rows.join(right.hint("merge"), on, how).drop(*(f"__not_{k}" for k in keys))
