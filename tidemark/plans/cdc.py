"""The change-driven model: silver tables are upserted, and gold follows their change feeds."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import path_exists
from tidemark.functions.clock import SILVER_FLOOR, as_datetime, ntz
from tidemark.functions.schemas import struct
from tidemark.functions.variants import renamed_fields
from tidemark.operators.changes import (
    DIM_ORDERSTATUS,
    DIM_USER,
    change_feed,
    effective_at,
    entered_facts,
    entering_orders,
    feeds_parts,
)
from tidemark.operators.dedup import newest_per_key
from tidemark.operators.keys import with_surrogate_keys
from tidemark.operators.merge import untouched
from tidemark.operators.scd import Dimension
from tidemark.operators.star import broken_links
from tidemark.operators.watermark import high_water_value, load_window
from tidemark.plans.stages import Warehouse
from tidemark.streaming.bronze import read_bronze
from tidemark.tables import SnapshotTable, create_or_replace

#: Silver commits that gold takes over in one commit of its own, at most.
FEEDS_AT_ONCE = 8
# When a row came to bronze, and when silver took it over; they say nothing about the row itself.
LOAD_TIMES = {"copied_at": "timestamp_ntz", "dbt_at": "timestamp_ntz"}
SILVER_USERS = struct(
    {
        "user_id": "bigint",
        "address": "string",
        "age": "bigint",
        "name": "string",
        "registered_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        **LOAD_TIMES,
    }
)
SILVER_ORDERS = struct(
    {
        "order_id": "bigint",
        "id_user": "bigint",
        "spent": "bigint",
        "status": "string",
        "ordered_at": "timestamp_ntz",
        "updated_at": "timestamp_ntz",
        **LOAD_TIMES,
    }
)
FACT = struct(
    {
        "id": "bigint",
        "order_id": "bigint",
        "orderstatus_id": "bigint",
        "orderuser_id": "bigint",
        "ordered_at": "timestamp_ntz",
    }
)


# Columns of the silver tables, and the field and type of the bronze record that each comes from.
USER_FIELDS = {
    "user_id": ("id", "bigint"),
    "address": ("address", "string"),
    "age": ("age", "bigint"),
    "name": ("name", "string"),
    "registered_at": ("created_at", "timestamp_ntz"),
    "updated_at": ("updated_at", "timestamp_ntz"),
}
ORDER_FIELDS = {
    "order_id": ("id", "bigint"),
    "id_user": ("id_user", "bigint"),
    "spent": ("spent", "bigint"),
    "status": ("status", "string"),
    "ordered_at": ("created_at", "timestamp_ntz"),
    "updated_at": ("updated_at", "timestamp_ntz"),
}


def users_to_silver(users: DataFrame) -> DataFrame:
    """Typed user rows with the names of the silver table."""
    return users.select(
        F.col("id").cast("bigint").alias("user_id"),
        "address",
        F.col("age").cast("bigint").alias("age"),
        "name",
        F.col("created_at").cast("timestamp_ntz").alias("registered_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


def orders_to_silver(orders: DataFrame) -> DataFrame:
    """Typed order rows with the names of the silver table."""
    return orders.select(
        F.col("id").cast("bigint").alias("order_id"),
        F.col("id_user").cast("bigint").alias("id_user"),
        F.col("spent").cast("bigint").alias("spent"),
        "status",
        F.col("created_at").cast("timestamp_ntz").alias("ordered_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


class ChangeWarehouse(Warehouse):
    """Silver tables, filled from bronze, and the gold tables that follow them.

    Each silver commit writes its changes once, from the batch and the stored rows it touches. A gold table is a
    consumer of its own: its commits carry the silver version they were made from, so the two consumers of the orders
    feed read it independently and a repeated run is a no-op.
    """

    def __init__(self, spark: SparkSession, root: str, overlap: timedelta | None = None):
        super().__init__(spark, root, (), overlap=overlap)

        def at(layer: str, name: str, schema: T.StructType, key: str, surrogate: str | None = None):
            return SnapshotTable(spark, f"{self.root}/{layer}/{name}", schema, key, surrogate)

        self.users = at("silver", "users_deduplicated", SILVER_USERS, "user_id")
        self.orders = at("silver", "orders_deduplicated", SILVER_ORDERS, "order_id")
        self.dim_user = at("gold", DIM_USER.name, DIM_USER.schema, DIM_USER.key, DIM_USER.surrogate)
        self.dim_orderstatus = at(
            "gold", DIM_ORDERSTATUS.name, DIM_ORDERSTATUS.schema, DIM_ORDERSTATUS.key, DIM_ORDERSTATUS.surrogate
        )
        self.fact_orders = at("gold", "fact_orders", FACT, "order_id", "id")
        self.publish_contracts("users", "orders")

    def run(self, users: DataFrame, orders: DataFrame, at: datetime | str) -> None:
        """Lands what is new or changed in both source tables, and loads it."""
        for entity, source in (("users", users), ("orders", orders)):
            self.extract_table(entity, source, at)
        self.load(at)

    def load(self, at: datetime | str) -> None:
        """Landed files to bronze, the bronze rows silver has not taken over yet to silver, their changes to gold."""
        self.ingest(("users", "orders"), at)
        self.upsert(
            self.window("users", self.users, USER_FIELDS, at), self.window("orders", self.orders, ORDER_FIELDS, at), str(at)
        )
        self.refresh()

    def window(self, entity: str, table: SnapshotTable, fields: Mapping[str, tuple[str, str]], at: datetime | str) -> DataFrame | None:
        """Typed bronze rows that came after the newest one in silver, until a time; None without any."""
        bronze = f"{self.root}/bronze/{entity}"
        if not path_exists(self.spark, bronze):
            return None
        low = high_water_value(table.current() if table.version else None, "copied_at", floor=SILVER_FLOOR)
        rows = read_bronze(self.spark, bronze).where(load_window("created_at", low, at))
        if rows.isEmpty():
            return None
        typed = renamed_fields(F.col("parquet_raw"), fields)
        return rows.select(*typed, F.col("created_at").alias("copied_at"), ntz(at).alias("dbt_at"))

    def upsert(self, users: DataFrame | None, orders: DataFrame | None, batch_id: str) -> None:
        """Brings delivered rows, in the shape of the silver tables, into silver, and writes their changes.

        The batch id is the time of the load; rows without load times get it. A commit that failed leaves a feed
        that the next attempt replaces: consumers read the feeds of committed versions only.
        """
        for table, batch, created in ((self.users, users, "registered_at"), (self.orders, orders, "ordered_at")):
            if batch is None or table.has(batch_id):
                continue
            times = {name: ntz(batch_id) for name in LOAD_TIMES if name not in batch.columns}
            newest = newest_per_key(batch.withColumns(times), table.key, "updated_at", created)
            version = f"{table.version + 1:06d}"
            newest = create_or_replace(newest.select(*table.schema.names), f"{table.path}/batch/{version}")

            def build(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
                keys = newest.select(F.col(table.key).alias("_key"))
                touched = stored.join(keys, F.col(table.key) == F.col("_key"), "left_semi")
                create_or_replace(change_feed(touched, newest, table.key, tuple(LOAD_TIMES)), f"{table.path}/feed/{version}")
                return untouched(stored, newest, table.key), newest

            table.merge(newest, batch_id, build, effective_only=True)

    def _pending(self, source: SnapshotTable, consumer: SnapshotTable) -> Iterator[tuple[str, DataFrame, list[tuple[int, str]]]]:
        """Feeds after the consumer's last position, some at once: their last position, their rows, and (number, time) of each.

        A row names its feed, and the time of the silver commit that the feed came from.
        """
        seen = int(consumer.commits[-1].batch_id) if consumer.commits else 0
        waiting = [(c.version, c.batch_id) for c in source.commits if c.version > seen]
        for lo in range(0, len(waiting), FEEDS_AT_ONCE):
            some = waiting[lo : lo + FEEDS_AT_ONCE]
            feeds = [
                self.spark.read.parquet(f"{source.path}/feed/{version:06d}").withColumns({"_feed": F.lit(version), "_at": ntz(time)})
                for version, time in some
            ]
            yield str(some[-1][0]), reduce(DataFrame.unionByName, feeds), some

    def _follow_dimension(self, source: SnapshotTable, table: SnapshotTable, dim: Dimension) -> None:
        for position, feeds, _ in self._pending(source, table):
            first = table.next_key()
            table.merge(feeds, position, lambda stored: feeds_parts(stored, feeds, dim, first))

    def _state(self, source: SnapshotTable, table: SnapshotTable, at: str, keys: DataFrame) -> DataFrame:
        """The versions of a dimension that were effective after the load of a time, at least those of some keys.

        The effective slice holds them unless the dimension has moved on. Then those that later commits closed are read
        with it, and no others of its history.
        """
        times = {str(c.version): as_datetime(c.batch_id) for c in source.commits}
        later = [c.version for c in table.commits if times[c.batch_id] > as_datetime(at)]
        if not later:
            return table.current()
        rows = table.current().unionByName(table.history(after=later[0] - 1))
        asked = keys.distinct().toDF("_key")
        return effective_at(rows.join(asked, F.col(table.key) == F.col("_key"), "left_semi"), at, table.key, table.surrogate)

    def refresh(self, as_of: datetime | str | None = None) -> None:
        """Applies all silver changes to gold, dimensions first; versions are valid from the time of their silver commit.

        Whether the commits are taken one by one or caught up together, the gold tables hold the same rows: each fact meets
        the versions that were effective after the load it came with.
        """
        self._follow_dimension(self.users, self.dim_user, DIM_USER)
        self._follow_dimension(self.orders, self.dim_orderstatus, DIM_ORDERSTATUS)
        for position, feeds, some in self._pending(self.orders, self.fact_orders):
            entering = entering_orders(feeds).select("order_id", "id_user", "ordered_at", "_feed")
            numbered = with_surrogate_keys(entering, by=["order_id"], first=self.fact_orders.next_key(), name="id", after="_feed")
            if len(some) > 1:
                numbered = create_or_replace(numbered, f"{self.fact_orders.path}/batch/{position}")
            facts = []
            for number, time in some:
                own = numbered.where(F.col("_feed") == number)
                status = self._state(self.orders, self.dim_orderstatus, time, own.select("order_id"))
                users = self._state(self.users, self.dim_user, time, own.select("id_user"))
                facts.append(entered_facts(own, status, users, counted=True))
            broken = broken_links("orderuser_id", "orderstatus_id")
            self.fact_orders.append(reduce(DataFrame.unionByName, facts), position, broken)
