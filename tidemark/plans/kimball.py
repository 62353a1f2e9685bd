"""The star model: two dimensions and one fact, loaded from one extract per table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schemas import struct
from tidemark.operators.audit import star_rules
from tidemark.operators.scd import DIM_STATUS, DIM_USERS, Dimension, scd2_parts
from tidemark.operators.star import broken_links, fact_orders
from tidemark.plans.stages import Warehouse
from tidemark.tables import SnapshotTable

FACT_ORDERS = struct(
    {
        "sk": "bigint",
        "id": "bigint",
        "created_at": "timestamp_ntz",
        "spent": "bigint",
        "id_dim_user": "bigint",
        "id_dim_status": "bigint",
    }
)
STATUSES = ("processing", "pending", "shipped")


class StarWarehouse(Warehouse):
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        statuses: Sequence[str] = STATUSES,
        stop_on_failure: bool = True,
        only_changed: bool = False,
        overlap: timedelta | None = None,
    ):
        super().__init__(spark, root, star_rules(statuses), stop_on_failure, overlap)
        self.only_changed = only_changed
        self.dim_users = self._dimension(DIM_USERS)
        self.dim_status = self._dimension(DIM_STATUS)
        self.fact_orders = self.gold("fact_orders", FACT_ORDERS, "id", "sk")
        self.publish_contracts("users", "orders")

    def _dimension(self, dim: Dimension) -> SnapshotTable:
        return self.gold(dim.name, dim.schema, dim.key, dim.surrogate)

    def _load_dimension(self, dim: Dimension, table: SnapshotTable, batch: DataFrame, batch_id: str, as_of) -> None:
        options = {"first_key": table.next_key(), "only_changed": self.only_changed, "effective_slice": True}
        table.merge(batch, batch_id, lambda stored: scd2_parts(stored, batch, dim, as_of, **options))

    def extract(self, users: DataFrame, orders: DataFrame, taken_at: datetime | str) -> None:
        """Lands what is new or changed in both source tables."""
        for entity, source in (("users", users), ("orders", orders)):
            self.extract_table(entity, source, taken_at)

    def load(self, as_of: datetime | str, max_files: int | None = None) -> None:
        """Loads everything landed so far into the gold tables."""

        def load_users(batch: DataFrame, batch_id: str) -> None:
            self._load_dimension(DIM_USERS, self.dim_users, batch, batch_id, as_of)

        def load_orders(batch: DataFrame, batch_id: str) -> None:
            self._load_dimension(DIM_STATUS, self.dim_status, batch, batch_id, as_of)
            if not self.fact_orders.has(batch_id):
                facts = fact_orders(
                    batch,
                    self.dim_users.current(),
                    self.dim_status.current(),
                    first_key=self.fact_orders.next_key(),
                    counted=True,
                )
                broken = broken_links("id_dim_user", "id_dim_status") | {"a repeated fact_orders.id": F.col("_copy") > 1}
                self.fact_orders.append(facts, batch_id, broken)

        self.ingest(("users", "orders"), as_of, max_files)
        for entity, apply in (("users", load_users), ("orders", load_orders)):
            self.refresh(entity, as_of, apply, max_files)

    def run(self, users: DataFrame, orders: DataFrame, at: datetime | str) -> None:
        self.extract(users, orders, at)
        self.load(at)
