"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash

BUCKET_DIGITS = 4  # 65,536 buckets: enough to spread over thousands of tasks, small enough to broadcast


def with_surrogate_keys(
    df: DataFrame,
    by: Sequence[str],
    first: int = 1,
    name: str = "sk",
    counted: DataFrame | None = None,
    after: str | None = None,
) -> DataFrame:
    """Adds ``first, first + 1, ...`` with no gap, one number per row.

    ``by`` names columns that identify a row. Rows are numbered inside hash buckets of those columns,
    and each bucket starts where the one before it ends. The numbers follow from the data alone, so a
    lost executor or a second evaluation gives the same keys. ``counted`` may be a frame with the same
    rows of the ``by`` columns that is cheaper to count than ``df``. ``after`` names a column of few values whose rows
    are numbered one value after the other, as if each value came in a batch of its own.
    """
    bucket = F.substring(row_hash(by), 1, BUCKET_DIGITS)
    if after:
        bucket = F.concat(F.lpad(F.col(after).cast("string"), 12, "0"), F.lit("-"), bucket)
    bucketed = df.withColumn("_bucket", bucket)
    # At most 16 ** BUCKET_DIGITS rows for a value of ``after``, whatever the size of the input.
    starts = (
        (df if counted is None else counted).groupBy(bucket.alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", (F.sum("_rows").over(Window.orderBy("_bucket")) - F.col("_rows")).alias("_start"))
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*by))
    numbered = bucketed.withColumn("_position", position).join(F.broadcast(starts), "_bucket")
    key = (F.col("_start") + F.col("_position") + F.lit(first - 1)).cast("bigint")
    return numbered.select(key.alias(name), *df.columns)


def next_key(df: DataFrame | None, name: str = "sk") -> int:
    """The key after the largest one in a table."""
    if df is None:
        return 1
    return (df.agg(F.max(name).alias("last")).first()["last"] or 0) + 1
