"""Source contracts and the landing schemas that follow from them."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.functions.schemas import struct

SCHEMA_VERSION = "1_0"
TAGS = ("schema_version", "schema_name", "schema_url")

# The columns each extract must deliver, and those that may be NULL.
SOURCE_COLUMNS = {
    "users": {
        "id": "int",
        "name": "string",
        "age": "int",
        "address": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    "orders": {
        "id": "int",
        "id_user": "int",
        "spent": "int",
        "status": "string",
        "created_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
    },
    "sales": {
        "order_id": "int",
        "order_id_user": "int",
        "order_spent": "int",
        "order_status": "string",
        "order_created_at": "timestamp_ntz",
        "order_updated_at": "timestamp_ntz",
        "user_id": "int",
        "user_name": "string",
        "user_age": "int",
        "user_address": "string",
        "user_created_at": "timestamp_ntz",
        "user_updated_at": "timestamp_ntz",
    },
}
NULLABLE = ("updated_at", "order_updated_at", "user_updated_at")


# The columns that say when a row was created and updated.
SOURCE_TIMES = {
    "users": ("created_at", "updated_at"),
    "orders": ("created_at", "updated_at"),
    "sales": ("order_created_at", "order_updated_at"),
}


def source_schema(entity: str) -> T.StructType:
    return struct(SOURCE_COLUMNS[entity], nullable=NULLABLE)


def schema_path(root: str, name: str, version: str = SCHEMA_VERSION) -> str:
    """The one place that knows where a schema document lies."""
    return f"{root.rstrip('/')}/schemas/{name}/{version}.json"


def is_time(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType))


def landing_schema(entity: str) -> T.StructType:
    return landed_form(source_schema(entity))


def landed_form(source: T.StructType) -> T.StructType:
    """Times become text and move behind the other columns; three tags end the record."""
    fields = source.fields
    plain = [f for f in fields if not is_time(f)]
    times = [T.StructField(f.name, T.StringType(), f.nullable) for f in fields if is_time(f)]
    tags = [T.StructField(name, T.StringType(), False) for name in TAGS]
    return T.StructType(plain + times + tags)


def stored_schema(entity: str) -> T.StructType:
    """The landing schema as files are read: an integer of any width is read as a long one."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
            for f in landing_schema(entity).fields
        ]
    )
