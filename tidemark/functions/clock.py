"""Times as data: every load time is an argument, so a re-run gives the same rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The watermark of a source that was never read, and that of an empty silver table.
EXTRACT_FLOOR = datetime(1000, 4, 13)
SILVER_FLOOR = datetime(1900, 1, 1)


def as_datetime(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def ntz(value: datetime | str | None) -> Column:
    """A literal TIMESTAMP_NTZ; same type as the columns it is compared with, so it is pushed down."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.expr(f"timestamp_ntz'{as_datetime(value).isoformat(sep=' ')}'")


def time_text(value: datetime | str) -> str:
    """``YYYY-MM-DD HH:MM:SS``, with the fraction of a second where there is one.

    A watermark that lost its fraction would select the rows of its last second again on every run.
    """
    return as_datetime(value).isoformat(sep=" ")
