"""Slowly changing dimensions of type 2: close the delivered keys, insert their new versions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clock import ntz
from tidemark.functions.schemas import struct
from tidemark.operators.contracts import require_not_null
from tidemark.operators.dedup import newest_per_key
from tidemark.operators.keys import with_surrogate_keys
from tidemark.operators.merge import close_versions
from tidemark.session import workspace
from tidemark.tables import create_or_replace


@dataclass(frozen=True)
class Dimension:
    """A dimension table: its natural key, its surrogate key and the typed columns a batch delivers."""

    name: str
    columns: tuple[tuple[str, str], ...]
    key: str = "id"
    surrogate: str = "sk"
    required: tuple[str, ...] | None = None  # columns that are never NULL; None: all of them

    @property
    def attributes(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        marks = {"valid_from": "timestamp_ntz", "is_effective": "boolean"}
        return struct({self.surrogate: "bigint", **dict(self.columns), **marks}, nullable=())

    def empty(self, spark: SparkSession) -> DataFrame:
        """The table before its first load."""
        return spark.createDataFrame([], self.schema).where(F.lit(False))


DIM_USERS = Dimension(
    "dim_users",
    (("id", "bigint"), ("name", "string"), ("age", "bigint"), ("address", "string"), ("created_at", "timestamp_ntz")),
)
DIM_STATUS = Dimension("dim_status", (("id", "bigint"), ("status", "string")))


def newest_states(batch: DataFrame, dim: Dimension) -> DataFrame:
    """Of several states of one key in a batch the newest."""
    times = [c for c in ("updated_at", "created_at") if c in batch.columns]
    return newest_per_key(batch, dim.key, *times)


def versions(
    batch: DataFrame,
    dim: Dimension,
    as_of: datetime | str,
    first_key: int = 1,
    latest_only: bool = True,
    unique: bool = False,
) -> DataFrame:
    """New effective versions with their surrogate keys, typed as the dimension declares.

    Of several states of one key in a batch the newest is kept; ``latest_only=False`` inserts them all.
    ``unique`` says that the batch holds one state per key already.
    """
    typed = [require_not_null(F.col(c).cast(t), f"{dim.name}.{c}").alias(c) for c, t in dim.columns]
    if not latest_only:
        # Numbered by whole states, so that the many states of one key are spread.
        keyed = with_surrogate_keys(batch, batch.columns, first_key, dim.surrogate).select(dim.surrogate, *typed)
    elif unique:
        keyed = with_surrogate_keys(batch.select(*typed), [dim.key], first_key, dim.surrogate)
    else:
        # One row per key: counting the keys needs no second pass over whole states.
        key_type = dict(dim.columns)[dim.key]
        members = batch.select(F.col(dim.key).cast(key_type).alias(dim.key)).distinct()
        states = newest_states(batch, dim).select(*typed)
        keyed = with_surrogate_keys(states, [dim.key], first_key, dim.surrogate, counted=members)
    return keyed.withColumns({"valid_from": ntz(as_of), "is_effective": F.lit(True)})


def changed_only(batch: DataFrame, effective: DataFrame, dim: Dimension) -> DataFrame:
    """Batch rows that differ from the effective version of their key, or have none.

    Joined on the key alone: both sides hold one row per key.
    """
    old = effective.select(*[F.col(c).alias(f"_old_{c}") for c in dim.attributes])
    same = F.lit(True)
    for c, sql_type in dim.columns:
        same = same & F.col(c).cast(sql_type).eqNullSafe(F.col(f"_old_{c}"))
    met = batch.join(old, F.col(dim.key) == F.col(f"_old_{dim.key}"), "left")
    return met.where(F.col(f"_old_{dim.key}").isNull() | ~same).select(*batch.columns)


def scd2_parts(
    table: DataFrame,
    batch: DataFrame,
    dim: Dimension,
    as_of: datetime | str,
    first_key: int = 1,
    latest_only: bool = True,
    only_changed: bool = False,
    effective_slice: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The stored versions, those of delivered keys closed, and the new versions of the batch.

    ``table`` may be the whole dimension or, with ``effective_slice``, only its effective versions:
    closed versions stay closed either way. With ``only_changed`` a row that brings nothing new opens
    no version; the rows that do are written once, since closing, numbering and inserting all read them.
    """
    if only_changed:
        states = newest_states(batch, dim) if latest_only else batch
        changed = changed_only(states, table.where("is_effective"), dim)
        batch = create_or_replace(changed, workspace(batch.sparkSession, f"{dim.name}_changed"))
    closed = close_versions(table, batch, dim.key, unique=effective_slice)
    return closed, versions(batch, dim, as_of, first_key, latest_only, unique=only_changed and latest_only)


def apply_scd2(table: DataFrame, batch: DataFrame, dim: Dimension, as_of: datetime | str, **options) -> DataFrame:
    """The dimension after one batch; options as in ``scd2_parts``."""
    closed, new = scd2_parts(table, batch, dim, as_of, **options)
    return closed.unionByName(new)


def with_valid_to(table: DataFrame, key: str = "id") -> DataFrame:
    """Adds the start of the key's next version; NULL for the last one.

    A load opens at most one version per key, so a key has no more versions than there were loads.
    """
    following = Window.partitionBy(key).orderBy("valid_from", "sk")
    return table.withColumn("valid_to", F.lead("valid_from").over(following))
