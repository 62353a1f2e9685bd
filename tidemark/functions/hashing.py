"""Row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "\\N"


def _field_text(name: str) -> Column:
    """Text of one field, with the separator and the escape sign escaped, and a mark for NULL."""
    text = F.replace(F.col(name).cast("string"), F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("|"), F.lit("\\|"))
    return F.coalesce(text, F.lit(NULL_MARK))


def row_hash(columns: Sequence[str]) -> Column:
    """md5 over the named fields; two rows that differ in any field differ in the hashed text."""
    return F.md5(F.concat_ws("|", *[_field_text(c) for c in columns]))


def record_hash(columns: Sequence[str]) -> Column:
    """md5 over the whole record as JSON, NULL fields included."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"}))
