"""Schema registry: one JSON document per schema name and version."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import write_text
from tidemark.functions import variants
from tidemark.operators.contracts import require_not_null
from tidemark.operators.dedup import ARRIVAL_ORDER, first_per_key
from tidemark.sources.contracts import SCHEMA_VERSION, TAGS, schema_path

VERSION_TAG = TAGS[0]


@dataclass(frozen=True)
class RegistryField:
    name: str
    type: str
    nullable: bool

    @property
    def sql_type(self) -> str:
        return variants.REGISTRY_TYPES[self.type]


def publish_schema(spark: SparkSession, root: str, name: str, schema: T.StructType, version: str = SCHEMA_VERSION) -> None:
    """Write a schema document where ``read_registry`` finds it."""
    write_text(spark, schema_path(root, name, version), schema.json())


def read_registry(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """``{name: {version: text}}`` of every document under ``schemas/``; metadata only."""
    path = F.col("_metadata.file_path")
    found = (
        spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
        .text(f"{root.rstrip('/')}/schemas")
        .select(
            F.regexp_extract(path, r"/schemas/([^/]+)/([^/]+?)\.json", 1).alias("name"),
            F.regexp_extract(path, r"/schemas/([^/]+)/([^/]+?)\.json", 2).alias("version"),
            "value",
        )
        .where("name <> ''")
    )
    registry: dict[str, dict[str, str]] = {}
    for row in found.collect():
        registry.setdefault(row.name, {})[row.version] = row.value
    return registry


def parse_schema(text: str) -> list[RegistryField]:
    """Fields of a schema document, in order. A type outside the registry's types is a KeyError."""
    fields = [RegistryField(f["name"], f["type"], f["nullable"]) for f in json.loads(text)["fields"]]
    for f in fields:
        variants.REGISTRY_TYPES[f.type]
    return fields


def registered_columns(fields: list[RegistryField], raw: str = "parquet_raw") -> list[Column]:
    """Typed columns of a record, in schema order; a NULL in a NOT NULL field fails the job."""
    columns: list[Column] = []
    for f in fields:
        value = variants.field(F.col(raw), f.name, f.sql_type)
        columns.append((value if f.nullable else require_not_null(value, f.name)).alias(f.name))
    return columns


def project_registered(df: DataFrame, fields: list[RegistryField], raw: str = "parquet_raw") -> DataFrame:
    """Each record as the typed columns of its schema."""
    return df.select(*registered_columns(fields, raw))


# Types that a field may have in one version, and its type where versions differ.
WIDER = {frozenset({"integer", "string"}): "string", frozenset({"datetime", "string"}): "string"}


def widened(versions: Mapping[str, list[RegistryField]]) -> list[RegistryField]:
    """The one schema that holds the rows of all versions: every field, in order of first appearance.

    A field that only some versions have may be NULL; two types of one field become the wider one, or a TypeError.
    """
    fields: dict[str, RegistryField] = {}
    for number, version in enumerate(sorted(versions)):
        for f in versions[version]:
            known = fields.get(f.name)
            if known is None:
                fields[f.name] = f if not number else replace(f, nullable=True)
            elif known.type != f.type and frozenset({known.type, f.type}) not in WIDER:
                raise TypeError(f"{f.name} is {known.type} in one version and {f.type} in another")
            else:
                kind = f.type if known.type == f.type else WIDER[frozenset({known.type, f.type})]
                fields[f.name] = RegistryField(f.name, kind, known.nullable or f.nullable)
        here = {f.name for f in versions[version]}
        fields = {n: f if n in here else replace(f, nullable=True) for n, f in fields.items()}
    return list(fields.values())


def versioned_columns(versions: Mapping[str, list[RegistryField]], raw: str = "parquet_raw") -> list[Column]:
    """Columns of the widened schema, each record by the version it was written with.

    A record of an unknown version fails the job by name. A field that the record's version does not have is NULL; one
    that it declares NOT NULL fails where it is missing. All in one projection: no version is read apart.
    """
    if len(versions) == 1:
        return registered_columns(next(iter(versions.values())), raw)
    version = variants.field(F.col(raw), VERSION_TAG, "string")
    unknown = F.raise_error(F.concat(F.lit("unknown schema version "), F.coalesce(version, F.lit("NULL"))))
    columns: list[Column] = []
    for f in widened(versions):
        value = variants.field(F.col(raw), f.name, f.sql_type)
        required = [v for v, fields in versions.items() if any(o.name == f.name and not o.nullable for o in fields)]
        if required:
            value = F.when(version.isin(required), require_not_null(value, f.name)).otherwise(value)
        if f.name == VERSION_TAG:
            value = F.when(version.isin(list(versions)), value).otherwise(unknown.cast("string"))
        columns.append(value.alias(f.name))
    return columns


def arriving_columns(versions: Mapping[str, list[RegistryField]]) -> list[Column]:
    """Typed columns of bronze records, widened over the versions of their schema, with what tells their arrival apart."""
    return [*versioned_columns(versions), F.struct("md5", *ARRIVAL_ORDER).alias("_arrival")]


def first_arrivals(typed: DataFrame) -> DataFrame:
    """Of rows of ``arriving_columns`` the first arrival of each record."""
    order = [F.col(f"_arrival.{c}") for c in ARRIVAL_ORDER]
    first = first_per_key(typed.withColumn("_md5", F.col("_arrival.md5")), ["_md5"], order)
    return first.drop("_md5", "_arrival")


def deduplicated_extract(bronze: DataFrame, versions: Mapping[str, list[RegistryField]]) -> DataFrame:
    """Typed columns of the first arrival of each record, widened over the versions of its schema.

    The fields are taken out before the shuffle: typed columns are narrower than whole records,
    which carry every field name.
    """
    return first_arrivals(bronze.select(*arriving_columns(versions)))
