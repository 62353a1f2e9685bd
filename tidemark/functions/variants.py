"""Typed access to fields of semi-structured records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The type names a registry schema may use, and the column types they stand for.
REGISTRY_TYPES = {
    "integer": "bigint",
    "string": "string",
    "datetime": "timestamp_ntz",
}


def field(raw: Column, name: str, sql_type: str, strict: bool = True) -> Column:
    """``raw:name::type``. A missing field is NULL; a value that cannot be cast raises unless not strict."""
    getter = F.variant_get if strict else F.try_variant_get
    return getter(raw, f"$.{name}", sql_type)


def whole_record(columns: Sequence[str]) -> Column:
    """All columns of a row as one VARIANT object."""
    return F.to_variant_object(F.struct(*[F.col(c) for c in columns]))


def renamed_fields(raw: Column, fields: Mapping[str, tuple[str, str]]) -> list[Column]:
    """``{output: (field, type)}`` as columns."""
    return [field(raw, name, sql_type).alias(out) for out, (name, sql_type) in fields.items()]
