"""The one-big-table model: sales, joined at extract and versioned by order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.audit import wide_rules
from tidemark.operators.wide import wide_parts
from tidemark.plans.kimball import STATUSES
from tidemark.plans.stages import Warehouse
from tidemark.sources.contracts import stored_schema
from tidemark.sources.incremental import ORDER_COLUMNS, joined_rows

FACT_SALES = T.StructType(
    [
        *stored_schema("sales").fields,
        T.StructField("valid_from", T.TimestampNTZType()),
        T.StructField("is_effective", T.BooleanType()),
    ]
)


class WideWarehouse(Warehouse):
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        statuses: Sequence[str] = STATUSES,
        stop_on_failure: bool = True,
        overlap: timedelta | None = None,
    ):
        super().__init__(spark, root, wide_rules(statuses), stop_on_failure, overlap)
        self.fact_sales = self.gold("fact_sales", FACT_SALES, "order_id")
        self.publish_contracts("sales")

    def run(self, users: DataFrame, orders: DataFrame, at: datetime | str) -> None:
        # Rows are known by their order alone: a changed user brings none.
        own = [f"order_{c}" for c in ORDER_COLUMNS]
        self.land("sales", self.unread("sales", lambda mark: joined_rows(orders, users, mark), at, own), at)
        self.ingest(["sales"], at)

        def load_sales(extract: DataFrame, batch_id: str) -> None:
            self.fact_sales.merge(extract, batch_id, lambda stored: wide_parts(stored, extract, at, effective_slice=True))

        self.refresh("sales", at, load_sales)
