"""High-water marks and load windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import EXTRACT_FLOOR, as_datetime, ntz


def high_water(df: DataFrame, *columns: str, floor: datetime | str = EXTRACT_FLOOR) -> DataFrame:
    """One row: the newest of the given times, or the floor when there is none."""
    newest = [F.max(F.col(c)) for c in columns]
    latest = F.greatest(*newest) if len(newest) > 1 else newest[0]
    return df.agg(F.coalesce(latest.cast("timestamp_ntz"), ntz(floor)).alias("watermark"))


def high_water_value(df: DataFrame | None, *columns: str, floor: datetime | str = EXTRACT_FLOOR) -> datetime:
    """The watermark as a value, to be used as a literal; a missing table gives the floor.

    A literal is pushed into the scan, a scalar subquery is not.
    """
    if df is None:
        return as_datetime(floor)
    return high_water(df, *columns, floor=floor).first()["watermark"]


def load_window(column: str, low: datetime | str, high: datetime | str, closed: str = "right") -> Column:
    """``(low, high]`` when closed on the right, ``[low, high)`` when closed on the left."""
    c = F.col(column)
    if closed == "right":
        return (c > ntz(low)) & (c <= ntz(high))
    if closed == "left":
        return (c >= ntz(low)) & (c < ntz(high))
    raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
