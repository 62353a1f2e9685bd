"""Users and orders as views of the driver's tables, in the shape of the operational source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import ntz


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _as_users(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 120).cast("int").alias("age"),
        F.col("c_mktsegment").alias("address"),
        F.expr("timestampadd(HOUR, c_custkey, timestamp_ntz'1995-01-01 00:00:00')").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return _as_users(table(spark, folder, "customer"))


def users_in_credit(spark: SparkSession, folder: str) -> DataFrame:
    """Users whose account is not overdrawn; the orders of the others have no such user."""
    return _as_users(table(spark, folder, "customer").where("c_acctbal >= 0"))


def users_updated(spark: SparkSession, folder: str) -> DataFrame:
    """Overdrawn users after their account has moved to another department."""
    moved = _as_users(table(spark, folder, "customer").where("c_acctbal < 0"))
    return moved.withColumns(
        {"address": F.lit("COLLECTIONS"), "updated_at": F.col("created_at") + F.expr("interval 30 day")}
    )


def users_last_state(spark: SparkSession, folder: str) -> DataFrame:
    return users_in_credit(spark, folder).unionByName(users_updated(spark, folder))


def _as_orders(rows: DataFrame) -> DataFrame:
    shipped = F.col("o_orderstatus") == "F"
    status = F.when(F.col("o_orderstatus") == "O", "processing").when(shipped, "shipped").otherwise("pending")
    return rows.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("id_user"),
        F.floor("o_totalprice").cast("bigint").alias("spent"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.when(shipped, F.col("o_orderdate") + F.expr("interval 7 day")).alias("updated_at"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Every order in its last state."""
    return _as_orders(table(spark, folder, "orders"))


def orders_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as it was placed: in process and not yet updated."""
    return orders(spark, folder).withColumns(
        {"status": F.lit("processing"), "updated_at": F.lit(None).cast("timestamp_ntz")}
    )


def orders_updated(spark: SparkSession, folder: str) -> DataFrame:
    """The orders that changed after they were placed, in their last state."""
    return _as_orders(table(spark, folder, "orders").where("o_orderstatus = 'F'"))


def orders_as_of(spark: SparkSession, folder: str, time: str) -> DataFrame:
    """The orders placed until a time, in the state they had then."""
    at = ntz(time)
    known = orders(spark, folder).where(F.col("created_at") <= at)
    later = F.col("updated_at") > at
    return known.withColumns(
        {
            "status": F.when(later, F.lit("processing")).otherwise(F.col("status")),
            "updated_at": F.when(~later, F.col("updated_at")),
        }
    )


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")
