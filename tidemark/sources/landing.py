"""Landing files: one folder of snappy parquet per extract batch."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import as_datetime
from tidemark.files import children, move, path_exists, remove
from tidemark.sources.contracts import SCHEMA_VERSION, TAGS, is_time, schema_path

# Unfinished attempts lie beside the landing zone, where no stream looks.
ATTEMPTS = "_attempts"
# Readers split a file between its row groups: small ones let all cores read what a few tasks have written.
GROUP_BYTES = 4 * 1024 * 1024


def timestamps_as_text(df: DataFrame) -> DataFrame:
    """Time columns as text, behind all other columns, in one projection."""
    times = [f.name for f in df.schema.fields if is_time(f)]
    others = [c for c in df.columns if c not in times]
    return df.select(*others, *[F.col(c).cast("string").alias(c) for c in times])


def tag_schema(df: DataFrame, entity: str, registry_root: str, version: str = SCHEMA_VERSION) -> DataFrame:
    """Every row names the schema it was written with."""
    values = (version, entity, schema_path(registry_root, entity, version))
    return df.withColumns({name: F.lit(value) for name, value in zip(TAGS, values)})


def landing_path(root: str, entity: str, taken_at: datetime | str, version: str = SCHEMA_VERSION) -> str:
    """``<entity>/<version>/<date>/<time>.parquet`` with padded parts, so paths sort by time."""
    at = as_datetime(taken_at)
    return f"{root.rstrip('/')}/{entity}/{version}/{at:%Y-%m-%d}/{at:%H_%M_%S}.parquet"


def write_landing(
    df: DataFrame,
    root: str,
    entity: str,
    taken_at: datetime | str,
    created: str = "created_at",
    updated: str = "updated_at",
    version: str = SCHEMA_VERSION,
) -> dict | None:
    """Land one batch and return ``{path, rows, watermark}``; an empty batch lands nothing.

    The source is read once: row count and next watermark are observed while the files are written. Each
    attempt writes a folder of its own beside the landing zone, and moving it to its place is the commit.
    A batch time that has landed stays as it is, so that a repeated run neither loses nor doubles rows.
    """
    spark, path = df.sparkSession, landing_path(root, entity, taken_at, version)
    if path_exists(spark, path):
        return landed_batch(spark, path, created, updated)
    attempt = f"{root.rstrip('/')}{ATTEMPTS}/{entity}-{uuid.uuid4().hex}"
    seen = Observation(f"landing_{entity}")
    newest = F.greatest(F.max(F.col(created)), F.max(F.col(updated))).cast("string")
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), newest.alias("watermark"))
    tagged = tag_schema(timestamps_as_text(observed), entity, root, version)
    tagged.write.option("compression", "snappy").option("parquet.block.size", GROUP_BYTES).parquet(attempt)
    if not seen.get["rows"]:
        remove(spark, attempt)
        return None
    move(spark, attempt, path)
    return {"path": path, **seen.get}


def landed_since(spark: SparkSession, root: str, entity: str, after: datetime | None = None) -> list[tuple[datetime, str]]:
    """Time and folder of the batches that landed after a time, in order; folders of earlier days are not listed."""
    home, found = f"{root.rstrip('/')}/{entity}", []
    for version in children(spark, home):
        for day in children(spark, f"{home}/{version}"):
            if after is None or day >= f"{after:%Y-%m-%d}":
                for name in children(spark, f"{home}/{version}/{day}"):
                    at = datetime.strptime(f"{day} {name}", "%Y-%m-%d %H_%M_%S.parquet")
                    found.append((at, f"{home}/{version}/{day}/{name}"))
    return sorted(f for f in found if after is None or f[0] > after)


def landed_batch(spark: SparkSession, path: str, created: str = "created_at", updated: str = "updated_at") -> dict:
    """``{path, rows, watermark}`` of files that have landed; their times are text that sorts by time."""
    files = spark.read.parquet(path)
    times = [F.max(F.col(c).cast("timestamp_ntz")) for c in (created, updated)]
    found = files.agg(F.count(F.lit(1)).alias("rows"), F.greatest(*times).cast("string").alias("watermark")).first()
    return {"path": path, **found.asDict()}


def read_landing(spark: SparkSession, root: str, entity: str, schema: T.StructType) -> DataFrame:
    """Every landed file of an entity, with its declared schema: no footer is read to infer one."""
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(f"{root.rstrip('/')}/{entity}")
    )


def query_staged(spark: SparkSession, path: str, fields: dict[str, str] | None = None) -> DataFrame:
    """Look into landed files: the whole record, or named fields with a cast."""
    files = spark.read.parquet(path)
    if fields is None:
        return files.select(F.to_variant_object(F.struct("*")).alias("record"))
    return files.select(*[F.col(name).cast(sql_type).alias(name) for name, sql_type in fields.items()])
