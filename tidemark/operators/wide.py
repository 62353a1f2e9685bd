"""The one big sales table: orders with their user, versioned by order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import ntz
from tidemark.operators.dedup import newest_per_key
from tidemark.operators.merge import close_versions

ORDER_TIMES = ("order_updated_at", "order_created_at")


def wide_versions(extract: DataFrame, as_of: datetime | str) -> DataFrame:
    """Every extracted column, the load time, and the effective mark."""
    return extract.select("*", ntz(as_of).alias("valid_from"), F.lit(True).alias("is_effective"))


def wide_parts(
    table: DataFrame, extract: DataFrame, as_of: datetime | str, key: str = "order_id", effective_slice: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The stored versions, those of delivered orders closed, and the newest state of each order."""
    times = [c for c in ORDER_TIMES if c in extract.columns]
    new = wide_versions(newest_per_key(extract, key, *times), as_of)
    return close_versions(table, extract, key, unique=effective_slice), new


def load_wide(
    table: DataFrame | None,
    extract: DataFrame,
    as_of: datetime | str,
    as_written: bool = False,
    key: str = "order_id",
) -> DataFrame:
    """The wide table after one batch.

    ``as_written`` follows the statements of the first design: a first run seeds the table, closes
    what it has just seeded and inserts it again. By default a first run seeds once, and of several
    states of one order in a batch only the newest is inserted.
    """
    new = wide_versions(extract, as_of)
    if as_written:
        return close_versions(new if table is None else table, extract, key).unionByName(new)
    closed, newest = wide_parts(new.limit(0) if table is None else table, extract, as_of, key)
    return closed.unionByName(newest)
