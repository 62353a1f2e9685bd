"""Schema contracts: column checks on typed rows, and keyword checks on JSON records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALID = "Given JSON data is Valid"
INVALID = "Given JSON data is InValid"

_NUMBER_TYPES = "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"

# The record schemas of the two source tables.
USERS_RECORD = {
    "type": "object",
    "properties": {
        "id": {"type": "number"},
        "address": {"type": "string"},
        "age": {"type": "number", "minimum": 1, "maximum": 110},
        "created_at": {"type": "string"},
        "updated_at": {"type": "string"},
        "name": {"type": "string"},
    },
    "required": ["id", "address", "age", "created_at", "name"],
}
ORDERS_RECORD = {
    "type": "object",
    "properties": {
        "id": {"type": "number"},
        "id_user": {"type": "number"},
        "created_at": {"type": "string"},
        "updated_at": {"type": "string"},
        "spent": {"type": "number", "minimum": 1},
        "status": {"type": "string"},
    },
    "required": ["id", "id_user", "created_at", "spent", "status"],
}


class ContractError(ValueError):
    """The columns of a batch do not match its contract."""


def require_not_null(value: Column, name: str) -> Column:
    """The value, or a failed job when it is NULL."""
    return F.coalesce(value, F.raise_error(F.lit(f"NULL in NOT NULL column {name}")))


def _family(data_type: T.DataType) -> str:
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    return data_type.typeName()


def column_mismatches(df: DataFrame, contract: T.StructType) -> list[str]:
    """Missing, unexpected and wrongly typed columns; any integer width serves an integer field."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    problems = [f"missing column {name}" for name in want if name not in have]
    problems += [f"unexpected column {name}" for name in have if name not in want]
    problems += [
        f"column {name} is {have[name].simpleString()}, not {want[name].simpleString()}"
        for name in want
        if name in have and _family(have[name]) != _family(want[name])
    ]
    return problems


def enforce(df: DataFrame, contract: T.StructType) -> DataFrame:
    """The batch in contract order; wrong columns fail at once, a NULL in a NOT NULL field on execution."""
    problems = column_mismatches(df, contract)
    if problems:
        raise ContractError("; ".join(problems))
    return df.select(
        *[
            F.col(f.name) if f.nullable else require_not_null(F.col(f.name), f.name).alias(f.name)
            for f in contract.fields
        ]
    )


def null_breaches(df: DataFrame, contract: T.StructType) -> DataFrame:
    """NULLs per NOT NULL field, counted in one pass: ``(field, breaches)``, fields without any left out."""
    fields = [f.name for f in contract.fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in fields])
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("breaches")) for n in fields])
    return counts.select(F.inline(pairs)).where("breaches > 0")


def _property_breaches(name: str, rule: Mapping) -> list[Column]:
    """One column per keyword of a property: a message, or NULL when the keyword holds."""
    kind = F.col(f"_kinds.{name}")
    checks = []
    if rule.get("type") == "number":
        checks.append(F.when(~kind.rlike(_NUMBER_TYPES), F.lit(f"{name}: not a number")))
    elif rule.get("type") == "string":
        checks.append(F.when(kind != "STRING", F.lit(f"{name}: not a string")))
    number = F.when(kind.rlike(_NUMBER_TYPES), F.try_variant_get(F.col(f"_values.{name}"), "$", "double"))
    if "minimum" in rule:
        checks.append(F.when(number < rule["minimum"], F.lit(f"{name}: below {rule['minimum']}")))
    if "maximum" in rule:
        checks.append(F.when(number > rule["maximum"], F.lit(f"{name}: above {rule['maximum']}")))
    return checks


def validate_records(df: DataFrame, json_column: str, schema: Mapping) -> DataFrame:
    """Adds ``valid``, ``message`` and ``breaches`` (an array) to each JSON record.

    Keywords used: type, required, minimum, maximum. A format names the meaning of a string and is
    not checked. Keywords on a property apply only where the property is present.
    """
    record = F.col("_record")
    properties = schema.get("properties", {})
    names = sorted({*properties, *schema.get("required", [])})
    values = [F.try_variant_get(record, f"$.{name}", "variant").alias(name) for name in names]
    kinds = [F.schema_of_variant(F.col(f"_values.{name}")).alias(name) for name in names]
    # Each step is its own projection, so a record is parsed once and a field is looked up once.
    looked_up = (
        df.withColumn("_record", F.try_parse_json(F.col(json_column)))
        .withColumns({"_values": F.struct(*values), "_is_object": F.schema_of_variant(record).startswith("OBJECT<")})
        .withColumn("_kinds", F.struct(*kinds))
    )
    checks = [
        F.when(F.col(f"_kinds.{name}").isNull(), F.lit(f"{name}: missing")) for name in schema.get("required", [])
    ]
    for name, rule in properties.items():
        checks += _property_breaches(name, rule)
    breaches = F.when(F.col("_is_object"), F.array_compact(F.array(*checks)))
    valid = F.size("breaches") == 0
    return (
        looked_up.withColumn("breaches", F.coalesce(breaches, F.array(F.lit("not an object"))))
        .withColumns({"valid": valid, "message": F.when(valid, F.lit(VALID)).otherwise(F.lit(INVALID))})
        .drop("_record", "_values", "_kinds", "_is_object")
    )
