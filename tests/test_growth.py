"""What keeps the loads in proportion to their input: nothing read whole for a part, no task with a whole table."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark.files import children
from tidemark.functions.schemas import struct
from tidemark.operators import joins
from tidemark.operators.scd import DIM_USERS
from tidemark.sources import landing
from tidemark.sources.contracts import stored_schema
from tidemark.streaming import bronze, delta
from tidemark.tables import SnapshotTable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def orders(spark, rows):
    return spark.range(0, rows, 1, 1).select(
        "id", (F.col("id") % 7).alias("id_user"), F.xxhash64("id").alias("spent"), F.lit("processing").alias("status"),
        F.expr("timestampadd(SECOND, id, timestamp_ntz'2001-01-01 00:00:00')").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def test_a_table_without_commits_costs_no_task(spark, tmp_path):
    table = SnapshotTable(spark, f"{tmp_path}/t", struct({"id": "bigint", "name": "string"}), "id")
    for empty in (table.current(), DIM_USERS.empty(spark)):
        assert empty.collect() == []
        assert "RDD" not in plan(empty)
    assert table.current().schema == table.schema


def test_a_batch_of_some_dozen_megabytes_is_merged_by_several_tasks(spark, tmp_path):
    source = spark.range(1_500_000).select("id", F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"))
    source.write.parquet(f"{tmp_path}/batch")  # about 35 MB, as numbers that hashes draw do not compress
    batch = spark.read.parquet(f"{tmp_path}/batch")
    table = SnapshotTable(spark, f"{tmp_path}/t", struct({"id": "bigint", "a": "bigint", "b": "bigint"}), "id")
    assert table.merge(batch, "1", lambda stored: (stored, batch), effective_only=True)
    assert table.partitions >= 4
    assert table.current().count() == 1_500_000


def test_landed_files_and_bronze_have_row_groups_that_tasks_can_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.sources.landing.GROUP_BYTES", 100_000)
    monkeypatch.setattr("tidemark.streaming.bronze.GROUP_BYTES", 100_000)
    landed = landing.write_landing(orders(spark, 60_000), f"{tmp_path}/landing", "orders", "2002-01-01 00:00:00")
    bronze.load_bronze(spark, f"{tmp_path}/landing/orders", stored_schema("orders"), f"{tmp_path}/bronze", f"{tmp_path}/cp", "2002-01-01 00:00:00")
    for folder in (landed["path"], f"{tmp_path}/bronze"):
        largest = max(pq.ParquetFile(f"{folder}/{n}").num_row_groups for n in children(spark, folder) if n.endswith(".parquet"))
        assert largest > 1


def test_a_consumer_is_handed_the_columns_that_its_stream_took_out(spark, tmp_path):
    landing.write_landing(orders(spark, 100), f"{tmp_path}/landing", "orders", "2002-01-01 00:00:00")
    bronze.load_bronze(spark, f"{tmp_path}/landing/orders", stored_schema("orders"), f"{tmp_path}/bronze", f"{tmp_path}/cp", "2002-01-01 00:00:00")
    seen = []
    wanted = [F.variant_get("parquet_raw", "$.id", "bigint").alias("id")]
    delta.consume(spark, f"{tmp_path}/bronze", f"{tmp_path}/taken", lambda rows, batch: seen.append((rows.columns, rows.count())), columns=wanted)
    assert seen == [(["id"], 100)]


def test_hot_keys_are_counted_on_the_frame_given_for_it(spark):
    """The rows to join may be dear to make; their keys alone are counted, once."""
    plain = spark.range(4000).select(F.when(F.col("id") < 3000, 5).otherwise(F.col("id")).alias("k"))
    dear = plain.withColumn("v", F.raise_error(F.lit("made for the count")).cast("long"))
    skew = joins.find_skew(plain, "k")
    assert skew.keys == [5] and not skew.nulls
    lookup = spark.range(10).select(F.col("id").alias("key"), F.lit(1).alias("x"))
    joined = joins.lookup_join(dear.repartition("v"), lookup, "k", "key", limit_bytes=0, counted=plain)
    assert "_salt" in plan(joined) or joined.columns == ["k", "v", "key", "x"]
