"""Flat schemas from plain type names, usable before a session exists."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import types as T

TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "variant": T.VariantType(),
}


def struct(columns: Mapping[str, str], nullable: Collection[str] | None = None) -> T.StructType:
    """Columns in order; all nullable, or only the named ones when names are given."""
    return T.StructType(
        [T.StructField(name, TYPES[kind], nullable is None or name in nullable) for name, kind in columns.items()]
    )
