"""Incremental reads of the operational tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import EXTRACT_FLOOR, ntz, time_text
from tidemark.functions.hashing import row_hash
from tidemark.operators.joins import lookup_join


ORDER_COLUMNS = ("id", "id_user", "spent", "status", "created_at", "updated_at")
USER_COLUMNS = ("id", "name", "age", "address", "created_at", "updated_at")


def newer_than(watermark: datetime | str, created: str = "created_at", updated: str = "updated_at") -> Column:
    """Created or updated strictly after the watermark. A NULL update time decides nothing."""
    mark = ntz(watermark)
    return (F.col(created) > mark) | (F.col(updated) > mark)


def incremental_rows(table: DataFrame, watermark: datetime | str = EXTRACT_FLOOR) -> DataFrame:
    """Rows that are new or changed since the watermark; the predicate reaches the scan."""
    return table.where(newer_than(watermark))


def not_landed(
    rows: DataFrame, landed: DataFrame, since: datetime | str, created: str, updated: str, columns: Sequence[str]
) -> DataFrame:
    """Rows read after ``since`` that no landed row of that time equals in ``columns``.

    A row that was committed late has a time that an earlier read has passed. Reading again from before the watermark
    finds it, and the hashes of what has landed since then take out what is known. ``landed`` has its times as text that
    sorts by time, so that the filter reaches its scan.
    """
    mark = time_text(since)
    seen = landed.where((F.col(created) > mark) | (F.col(updated) > mark)).select(row_hash(columns).alias("_seen")).distinct()
    hashed = rows.withColumn("_hash", row_hash(columns))
    return lookup_join(hashed, seen, "_hash", "_seen", how="left_anti").drop("_hash")


def joined_rows(orders: DataFrame, users: DataFrame, watermark: datetime | str = EXTRACT_FLOOR) -> DataFrame:
    """New or changed orders with their user, as twelve prefixed columns.

    Only the order's own times count: a changed user alone brings no row.
    """
    wide_orders = incremental_rows(orders, watermark).select(
        *[F.col(c).alias(f"order_{c}") for c in ORDER_COLUMNS]
    )
    wide_users = users.select(*[F.col(c).alias(f"user_{c}") for c in USER_COLUMNS])
    return lookup_join(wide_orders, wide_users, "order_id_user", "user_id")


def jdbc_options(
    url: str,
    table: str,
    watermark: datetime | str = EXTRACT_FLOOR,
    split: tuple[str, int, int, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read that runs the watermark filter in the source database.

    ``split`` is ``(column, lower, upper, partitions)``: parallel range reads over an indexed
    integer column instead of one connection. The bounds only shape the ranges, they drop no rows.
    """
    return _read_options(url, f"select * from {table} where {_newer_text(watermark)}", f"newer_{table}", split, extra)


def joined_jdbc_options(
    url: str,
    watermark: datetime | str = EXTRACT_FLOOR,
    split: tuple[str, int, int, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read that joins new or changed orders with their users in the source database.

    The rows are those of ``joined_rows``; a ``split`` is best over ``order_id``.
    """
    columns = [f"o.{c} as order_{c}" for c in ORDER_COLUMNS] + [f"u.{c} as user_{c}" for c in USER_COLUMNS]
    query = (
        f"select {', '.join(columns)} from orders o left join users u on o.id_user = u.id "
        f"where {_newer_text(watermark, 'o.')}"
    )
    return _read_options(url, query, "newer_sales", split, extra)


def _newer_text(watermark: datetime | str, prefix: str = "") -> str:
    mark = time_text(watermark)
    return f"{prefix}created_at > '{mark}' or {prefix}updated_at > '{mark}'"


def _read_options(
    url: str, query: str, name: str, split: tuple[str, int, int, int] | None, extra: dict[str, str]
) -> dict[str, str]:
    options = {"url": url, "dbtable": f"({query}) as {name}", **extra}
    if split:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    # Database times carry no zone; they stay wall-clock times as in the parquet sources.
    return spark.read.format("jdbc").option("preferTimestampNTZ", "true").options(**options).load()
