"""Incremental reads, landing files, contracts of files, and the schema registry."""

from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from seed import LATER, PLACED, RUN_1, orders, rows, users
from tidemark.functions.clock import EXTRACT_FLOOR
from tidemark.functions.variants import field as variant_field
from tidemark.functions.variants import whole_record
from tidemark.operators.watermark import high_water_value, load_window
from tidemark.sources import incremental, landing, registry
from tidemark.sources.contracts import landing_schema, schema_path, stored_schema
from tidemark.streaming.bronze import load_bronze, read_bronze


def test_watermark_is_strict_and_a_null_update_decides_nothing(spark):
    batch = orders(
        spark,
        [
            (1, 1, 1, "a", PLACED, None),
            (2, 1, 1, "a", LATER, None),
            (3, 1, 1, "a", PLACED, LATER),
            (4, 1, 1, "a", PLACED, PLACED),
        ],
    )
    assert sorted(r.id for r in incremental.incremental_rows(batch, PLACED).collect()) == [2, 3]
    assert incremental.incremental_rows(batch).count() == 4


def test_watermark_keeps_fractions_of_a_second(spark):
    batch = orders(spark, [(1, 1, 1, "a", datetime(2021, 1, 1, 0, 0, 0, 500), None)])
    assert incremental.incremental_rows(batch, "2021-01-01 00:00:00.000499").count() == 1
    assert incremental.incremental_rows(batch, "2021-01-01 00:00:00.000500").count() == 0
    assert "'2021-01-01 00:00:00.000500'" in incremental.jdbc_options("u", "orders", "2021-01-01 00:00:00.000500")["dbtable"]


def test_joined_rows_keep_orders_without_a_user_and_drop_users_without_an_order(spark):
    batch = orders(spark, [(1, 1, 30, "processing", PLACED, None), (2, 9, 20, "processing", PLACED, None)])
    joined = incremental.joined_rows(batch, users(spark))
    assert joined.columns == [
        "order_id", "order_id_user", "order_spent", "order_status", "order_created_at", "order_updated_at",
        "user_id", "user_name", "user_age", "user_address", "user_created_at", "user_updated_at",
    ]
    assert {(r.order_id, r.user_name) for r in joined.collect()} == {(1, "francisco"), (2, None)}


def test_a_changed_user_alone_brings_no_row(spark):
    moved = users(spark, [(1, "francisco", 34, "elsewhere", PLACED, LATER)])
    assert incremental.joined_rows(orders(spark), moved, PLACED).count() == 0


def test_high_water(spark):
    batch = orders(spark, [(1, 1, 1, "a", PLACED, None), (2, 1, 1, "a", PLACED, LATER)])
    assert high_water_value(batch, "created_at", "updated_at") == LATER
    assert high_water_value(batch, "created_at") == PLACED
    assert high_water_value(batch.limit(0), "created_at", "updated_at") == EXTRACT_FLOOR
    assert high_water_value(None, "created_at") == EXTRACT_FLOOR


def test_load_windows_at_their_bounds(spark):
    times = spark.createDataFrame([(PLACED,), (LATER,)], "t timestamp_ntz")
    assert [r.t for r in times.where(load_window("t", PLACED, LATER, "right")).collect()] == [LATER]
    assert [r.t for r in times.where(load_window("t", PLACED, LATER, "left")).collect()] == [PLACED]
    with pytest.raises(ValueError):
        load_window("t", PLACED, LATER, "both")


def test_jdbc_options_filter_in_the_source_and_read_in_parallel():
    options = incremental.jdbc_options("jdbc:mysql://host/db", "orders", PLACED, ("id", 1, 1000, 16), user="u")
    assert "created_at > '2021-12-08 20:02:42' or updated_at > '2021-12-08 20:02:42'" in options["dbtable"]
    assert options["numPartitions"] == "16" and options["user"] == "u"
    floor = incremental.jdbc_options("jdbc:mysql://host/db", "users")
    assert "1000-04-13 00:00:00" in floor["dbtable"] and "numPartitions" not in floor


def test_landing_columns_and_path(spark):
    tagged = landing.tag_schema(landing.timestamps_as_text(orders(spark)), "orders", "root")
    assert tagged.columns == [f.name for f in landing_schema("orders").fields]
    first = min(tagged.collect(), key=lambda r: r.id)
    assert first.created_at == "2021-12-08 20:02:42" and first.updated_at is None
    assert (first.schema_version, first.schema_name, first.schema_url) == ("1_0", "orders", "root/schemas/orders/1_0.json")
    assert landing.landing_path("root", "users", "2021-02-03 04:05:06") == "root/users/1_0/2021-02-03/04_05_06.parquet"


def test_landing_write_reports_rows_and_watermark_and_skips_an_empty_batch(spark, tmp_path):
    root = str(tmp_path)
    assert landing.write_landing(orders(spark).limit(0), root, "orders", RUN_1) is None
    landed = landing.write_landing(orders(spark), root, "orders", RUN_1)
    assert landed["rows"] == 3 and landed["watermark"] == "2021-12-08 20:02:42"
    again = landing.write_landing(orders(spark).limit(1), root, "orders", RUN_1)  # this batch time has landed
    assert again == landed
    assert landing.read_landing(spark, root, "orders", stored_schema("orders")).count() == 3


def test_staged_file_whole_or_by_field(spark, tmp_path):
    path = landing.write_landing(users(spark), str(tmp_path), "users", RUN_1)["path"]
    record = landing.query_staged(spark, path).select(F.variant_get("record", "$.name", "string").alias("name"))
    assert rows(record) == [("francisco",), ("john",), ("samuel",)]
    assert rows(landing.query_staged(spark, path, {"id": "string"})) == [("1",), ("2",), ("3",)]


def test_registry_round_trip_and_projection(spark, tmp_path):
    root = str(tmp_path)
    for entity in ("users", "orders"):
        registry.publish_schema(spark, root, entity, landing_schema(entity))
    found = registry.read_registry(spark, root)
    assert set(found) == {"users", "orders"} and set(found["users"]) == {"1_0"}
    fields = registry.parse_schema(found["orders"]["1_0"])
    assert [f.name for f in fields] == [f.name for f in landing_schema("orders").fields]
    landed = landing.tag_schema(landing.timestamps_as_text(orders(spark)), "orders", root)
    raw = landed.select(whole_record(landed.columns).alias("parquet_raw"))
    typed = registry.project_registered(raw, fields)
    assert typed.schema["spent"].dataType.simpleString() == "bigint"
    assert sum(r.spent for r in typed.collect()) == 150


def test_registry_reads_plain_files_too(spark, tmp_path):
    place = tmp_path / "schemas" / "users"
    place.mkdir(parents=True)
    (place / "1_0.json").write_text(landing_schema("users").json())
    (place / "notes.txt").write_text("no schema")
    assert set(registry.read_registry(spark, str(tmp_path))) == {"users"}
    assert schema_path("root/", "users") == "root/schemas/users/1_0.json"


def test_unknown_registry_type_is_an_error():
    with pytest.raises(KeyError):
        registry.parse_schema('{"fields": [{"name": "created_at", "type": "timestamp", "nullable": true, "metadata": {}}]}')


def test_projection_fails_on_a_null_and_on_a_wrong_type(spark):
    fields = registry.parse_schema('{"fields": [{"name": "id", "type": "integer", "nullable": false}]}')
    for text, reason in (('{"other": 1}', "NOT NULL"), ('{"id": "x"}', "INVALID_VARIANT_CAST")):
        raw = spark.createDataFrame([(text,)], "t string").select(F.parse_json("t").alias("parquet_raw"))
        with pytest.raises(Exception, match=reason):
            registry.project_registered(raw, fields).collect()


def test_watermark_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(spark).write.parquet(path)
    plan = incremental.incremental_rows(spark.read.parquet(path), PLACED)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].splitlines()[0]
    assert "Or(GreaterThan(created_at" in pushed and "GreaterThan(updated_at" in pushed


def test_joined_jdbc_read_joins_and_filters_in_the_source():
    options = incremental.joined_jdbc_options("jdbc:x", "2021-01-01 00:00:00.5", ("order_id", 1, 100, 8), fetchsize="1000")
    query = options["dbtable"]
    assert query.startswith("(select o.id as order_id, o.id_user as order_id_user,") and query.endswith(") as newer_sales")
    assert "from orders o left join users u on o.id_user = u.id where" in query
    assert "o.created_at > '2021-01-01 00:00:00.500000' or o.updated_at > '2021-01-01 00:00:00.500000'" in query
    assert (options["partitionColumn"], options["numPartitions"], options["fetchsize"]) == ("order_id", "8", "1000")
    assert "partitionColumn" not in incremental.joined_jdbc_options("jdbc:x")


def test_bronze_records_are_typed_columns_of_their_fields(spark, tmp_path):
    root = str(tmp_path)
    many = spark.range(20_000).selectExpr(
        "int(id) id", "int(id % 50) id_user", "int(id % 97) spent", "repeat(sha2(string(id), 256), 4) status",
        "timestamp_ntz'2021-12-08 20:02:42' created_at", "cast(null as timestamp_ntz) updated_at",
    )
    landing.write_landing(many.coalesce(1), root, "orders", RUN_1)
    load_bronze(spark, f"{root}/orders", stored_schema("orders"), f"{root}/bronze", f"{root}/cp", RUN_1)
    (file,) = (tmp_path / "bronze").glob("*.parquet")
    record = pq.read_schema(file).field("parquet_raw").type
    typed = record.field("typed_value").type
    assert {"id", "spent", "status", "created_at"} <= {typed.field(i).name for i in range(typed.num_fields)}
    # A query of one field names it in the schema of its scan, and the bytes of that field are few.
    spent = read_bronze(spark, f"{root}/bronze").select(variant_field(F.col("parquet_raw"), "spent", "bigint").alias("spent"))
    plan = spent._jdf.queryExecution().executedPlan().toString()
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert "variant" not in schema and "struct<parquet_raw:struct<" in schema
    group = pq.ParquetFile(file).metadata.row_group(0)
    sizes = {group.column(i).path_in_schema: group.column(i).total_compressed_size for i in range(group.num_columns)}
    of = lambda name: sum(n for path, n in sizes.items() if path.startswith(f"parquet_raw.typed_value.{name}."))
    assert 0 < 20 * of("spent") < sum(sizes.values())
    assert spent.agg(F.sum("spent")).first()[0] == sum(i % 97 for i in range(20_000))
