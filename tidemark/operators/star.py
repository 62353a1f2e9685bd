"""Fact loads: orders pointed at the versions of their dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.contracts import require_not_null
from tidemark.operators.joins import lookup_join
from tidemark.operators.keys import with_surrogate_keys


def star_join(
    rows: DataFrame,
    users: DataFrame,
    status: DataFrame,
    user_link: tuple[str, str],
    status_link: tuple[str, str],
    surrogate: str = "sk",
    effective: bool = True,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left joins to both dimensions, adding ``_user_sk`` and ``_status_sk``.

    Each link is ``(column of the rows, key of the dimension)``. With ``effective`` only the current
    version of a key is met and the row count stays; without it every version of a key adds a row. ``counted`` may be the
    rows before they were numbered, for the count of hot keys.
    """
    for dim, (row_key, dim_key), name in ((users, user_link, "_user"), (status, status_link, "_status")):
        versions = dim.where("is_effective") if effective else dim
        lookup = versions.select(F.col(dim_key).alias(f"{name}_key"), F.col(surrogate).alias(f"{name}_sk"))
        if effective and name == "_status":
            # An order meets its own status: one row per key on both sides, so no key is hot.
            rows = rows.join(lookup, F.col(row_key) == F.col(f"{name}_key"), "left").drop(f"{name}_key")
        else:
            rows = lookup_join(rows, lookup, row_key, f"{name}_key", counted=counted if name == "_user" else None).drop(f"{name}_key")
    return rows


def fact_orders(
    orders: DataFrame,
    dim_users: DataFrame,
    dim_status: DataFrame,
    effective: bool = True,
    first_key: int = 1,
    counted: bool = False,
) -> DataFrame:
    """New orders (never updated) with the keys of their user and status versions.

    A missing version fails the job. With ``counted`` such rows keep a NULL key and ``_copy`` numbers the facts of each order,
    so that the write of the facts can count what is wrong (``broken_links``). Facts have met their status by the same
    key, so beyond the broadcast limit they are numbered where that join left them.
    """
    new = orders.where(F.col("updated_at").isNull()).select(
        F.col("id").cast("bigint").alias("id"),
        F.col("id_user").cast("bigint").alias("id_user"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("spent").cast("bigint").alias("spent"),
    )
    plain = new
    if effective:
        # One fact per order: number the narrow rows before the joins, so the joins run once.
        new = with_surrogate_keys(new, by=["id", "id_user", "created_at", "spent"], first=first_key)
    facts = star_join(new, dim_users, dim_status, ("id_user", "id"), ("id", "id"), effective=effective, counted=plain)
    if not effective:
        by = ["id", "id_user", "created_at", "spent", "_user_sk", "_status_sk"]
        facts = with_surrogate_keys(facts, by=by, first=first_key)
    own = ["sk", _required("id"), _required("created_at"), _required("spent")]
    links = {"_user_sk": "id_dim_user", "_status_sk": "id_dim_status"}
    if counted:
        copy = F.row_number().over(Window.partitionBy("id").orderBy("id"))
        return facts.select(*own, *[F.col(c).alias(name) for c, name in links.items()], copy.alias("_copy"))
    return facts.select(*own, *[_required(c, name) for c, name in links.items()])


def broken_links(*columns: str) -> dict[str, Column]:
    """What no written fact may be: one whose link names no version of its dimension."""
    return {f"fact_orders.{c} of no version": F.col(c).isNull() for c in columns}


def _required(column: str, name: str | None = None) -> Column:
    name = name or column
    return require_not_null(F.col(column), f"fact_orders.{name}").alias(name)
