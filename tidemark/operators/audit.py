"""Data-quality audit: a rule catalogue, one pass per table, a table of failures and a gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.clock import ntz

NOT_EMPTY = "not empty"
RULES = "id bigint, description string, table_name string, test_sql string"
FAILURES = "id bigint, id_dim_tests bigint, amount_records_failing bigint, timestamp timestamp_ntz"


@dataclass(frozen=True)
class Rule:
    """A rule of one table; ``failing`` is the SQL predicate of a failing row, or ``NOT_EMPTY``."""

    id: int
    description: str
    table_name: str
    failing: str

    def failures(self) -> Column:
        if self.failing == NOT_EMPTY:
            return F.when(F.count(F.lit(1)) == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        return F.count_if(F.expr(self.failing))


class AuditFailed(RuntimeError):
    """At least one rule found failing rows."""


def not_in_list(column: str, allowed: Sequence[str]) -> str:
    values = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in allowed)
    return f"{column} not in ({values})"


# The numbers and texts of the rules.


def star_rules(
    statuses: Sequence[str], users: str = "users_extract_cast", orders: str = "orders_extract_cast"
) -> list[Rule]:
    """The five rules of the star model; the allowed statuses are the caller's."""
    return [
        Rule(1, f"check {users} table is not empty", users, NOT_EMPTY),
        Rule(2, f"check {users} age is between 0 and 100", users, "age < 0 or age > 100"),
        Rule(3, f"check {users} name is not empty", users, "name is null or name = ''"),
        Rule(4, f"check {orders} spent is not null or negative", orders, "spent is null or spent <= 0"),
        Rule(5, f"check {orders} status is valid", orders, not_in_list("status", statuses)),
    ]


def wide_rules(statuses: Sequence[str], sales: str = "sales_extract_cast") -> list[Rule]:
    """The same rules for the wide model, on its own columns."""
    return [
        Rule(1, f"check {sales} table is not empty", sales, NOT_EMPTY),
        Rule(2, f"check {sales} age is between 0 and 100", sales, "user_age < 0 or user_age > 100"),
        Rule(3, f"check {sales} name is not empty", sales, "user_name is null or user_name = ''"),
        Rule(4, f"check {sales} spent is not null or negative", sales, "order_spent is null or order_spent <= 0"),
        Rule(5, f"check {sales} status is valid", sales, not_in_list("order_status", statuses)),
    ]


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The catalogue as a table, replaced on every run."""
    rows = [(r.id, r.description, r.table_name, r.failing) for r in rules]
    return spark.createDataFrame(rows, RULES)


def run_audit(tables: Mapping[str, DataFrame], rules: Sequence[Rule], as_of: datetime | str, first_id: int = 1) -> DataFrame:
    """One row per failed rule, with its number of failing rows, numbered from ``first_id``.

    All rules of a table are counted in one scan, and no failing row leaves the executors.
    """
    counted = []
    for name, table in tables.items():
        own = [r for r in rules if r.table_name == name]
        if not own:
            continue
        counts = table.agg(*[r.failures().alias(f"rule_{r.id}") for r in own])
        pairs = F.array(
            *[
                F.struct(F.lit(r.id).cast("bigint").alias("id_dim_tests"), F.col(f"rule_{r.id}").alias("amount_records_failing"))
                for r in own
            ]
        )
        counted.append(counts.select(F.inline(pairs)))
    failed = reduce(DataFrame.unionByName, counted).where("amount_records_failing > 0")
    # At most one row per rule reaches this window.
    return failed.select(
        (F.row_number().over(Window.orderBy("id_dim_tests")) + F.lit(first_id - 1)).cast("bigint").alias("id"),
        "id_dim_tests",
        "amount_records_failing",
        ntz(as_of).alias("timestamp"),
    )


def gate(failures: DataFrame) -> DataFrame:
    """One row: whether the batch may pass, and how many rules failed."""
    return failures.agg(
        (F.count(F.lit(1)) == 0).alias("passed"),
        F.count(F.lit(1)).alias("failed_rules"),
    )


def require_passed(failures: DataFrame) -> None:
    """Stops a load whose batch failed a rule."""
    failed = failures.collect()  # at most one row per rule
    if failed:
        listed = ", ".join(f"rule {r.id_dim_tests}: {r.amount_records_failing} rows" for r in failed)
        raise AuditFailed(listed)
