"""The query catalogue: every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import SILVER_FLOOR, ntz
from tidemark.functions.hashing import record_hash, row_hash
from tidemark.functions.schemas import struct
from tidemark.functions.variants import field, renamed_fields, whole_record
from tidemark.operators import audit, changes, constraints, contracts, dedup, keys, merge, scd, star, watermark, wide
from tidemark.plans import views
from tidemark.plans.cdc import ORDER_FIELDS, USER_FIELDS, ChangeWarehouse, orders_to_silver, users_to_silver
from tidemark.plans.kimball import StarWarehouse
from tidemark.plans.obt import WideWarehouse
from tidemark.plans.stages import Warehouse
from tidemark.session import workspace
from tidemark.sources import incremental, landing
from tidemark.sources.contracts import landing_schema, source_schema, stored_schema
from tidemark.sources.registry import deduplicated_extract, parse_schema, project_registered
from tidemark.streaming.bronze import bronze_rows, load_bronze, read_bronze
from tidemark.streaming.delta import take_current
from tidemark.tables import KeyViolation, create_or_replace

# The times the queries run at; the oracles use the same ones.
WATERMARK = "2000-01-01 00:00:00"
SILVER_UNTIL = "1998-01-01 00:00:00"
WINDOW_END = "2000-01-01 00:00:00"
EVENTS_FROM, EVENTS_UNTIL = "2024-01-05 00:00:00", "2024-01-20 00:00:00"
FIRST_LOAD, SECOND_LOAD, THIRD_LOAD = "2002-01-01 00:00:00", "2002-02-01 00:00:00", "2002-03-01 00:00:00"
USERS_UNTIL = "1995-01-05 00:00:00"
KEPT_SINCE = "1996-01-01 00:00:00"
AGES, OLDEST_AUDITED = 120, 100  # the users' ages run through all below 120, the audit passes those up to 100
LATE_BY = timedelta(days=30)
USERS_SECOND_VERSION = struct(
    {"id": "int", "name": "string", "age": "int", "segment": "string", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"},
    nullable=("updated_at",),
)
AUDITED_STATUSES = ("processing", "shipped")
REGISTRY_ROOT = "landing"
PROPS_RECORD = {
    "type": "object",
    "properties": {"k": {"type": "number", "minimum": 1, "maximum": 90}},
    "required": ["k"],
}

Query = Callable[[SparkSession, str], DataFrame]


# Sources


def incremental_extract(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.incremental_rows(views.orders(spark, folder), WATERMARK)


def obt_extract(spark: SparkSession, folder: str) -> DataFrame:
    return incremental.joined_rows(views.orders(spark, folder), views.users(spark, folder), WATERMARK)


def watermark_floor(spark: SparkSession, folder: str) -> DataFrame:
    """Per entity its watermark; the sales table has no row after the newest order, so it gets the floor."""
    orders = views.orders(spark, folder)
    newest = watermark.high_water_value(orders, "created_at", "updated_at")
    entities = {
        "users": views.users_last_state(spark, folder),
        "orders": orders,
        "sales": incremental.incremental_rows(orders, newest),
    }
    rows = [
        watermark.high_water(df, "created_at", "updated_at").select(F.lit(name).alias("entity"), "watermark")
        for name, df in entities.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def watermark_window(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of both load windows, from the newest row that silver has taken over."""
    orders = views.orders(spark, folder)
    silver = orders.where(F.col("created_at") <= ntz(SILVER_UNTIL))
    low = watermark.high_water_value(silver, "created_at", floor=SILVER_FLOOR)
    return orders.agg(
        F.count_if(watermark.load_window("created_at", low, WINDOW_END, "right")).alias("closed_right"),
        F.count_if(watermark.load_window("created_at", low, WINDOW_END, "left")).alias("closed_left"),
    )


def landing_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Users landed as files and read back; the tag with the place of the run is left out."""
    root = workspace(spark, "landing_scan")
    landing.write_landing(views.users(spark, folder), root, "users", FIRST_LOAD)
    return landing.read_landing(spark, root, "users", stored_schema("users")).drop("schema_url")


def staged_file(spark: SparkSession, folder: str) -> DataFrame:
    root = workspace(spark, "staged_file")
    landed = landing.write_landing(views.users(spark, folder), root, "users", FIRST_LOAD)
    return landing.query_staged(spark, landed["path"], {"id": "bigint", "name": "string", "created_at": "timestamp_ntz"})


# Projections and hashes


def tag_schema(spark: SparkSession, folder: str) -> DataFrame:
    return landing.tag_schema(views.orders(spark, folder), "orders", REGISTRY_ROOT)


def timestamps_as_text(spark: SparkSession, folder: str) -> DataFrame:
    return landing.timestamps_as_text(views.orders(spark, folder))


def row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    orders = views.orders(spark, folder)
    return orders.select("id", row_hash(orders.columns).alias("md5"))


def bronze_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as bronze takes them over: the record, and the file and row it came from."""
    rows = bronze_rows(views.table(spark, folder, "orders"), FIRST_LOAD)
    return rows.select(
        field(F.col("parquet_raw"), "o_orderkey", "bigint").alias("id"),
        field(F.col("parquet_raw"), "o_custkey", "bigint").alias("id_user"),
        F.element_at(F.split("source", "/"), -1).alias("file"),
        "metadata_row_number",
        "created_at",
    )


def _raw(rows: DataFrame, entity: str) -> DataFrame:
    """Rows as bronze holds them: one object per record."""
    landed = landing.tag_schema(landing.timestamps_as_text(rows), entity, REGISTRY_ROOT)
    return landed.select(whole_record(landed.columns).alias("parquet_raw"), record_hash(landed.columns).alias("md5"))


def extract_cast(spark: SparkSession, folder: str) -> DataFrame:
    fields = parse_schema(landing_schema("orders").json())
    return project_registered(_raw(views.orders(spark, folder), "orders"), fields)


def extract_fixed(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(views.users_last_state(spark, folder), "users")
    return raw.select(*renamed_fields(F.col("parquet_raw"), USER_FIELDS))


def extract_props(spark: SparkSession, folder: str) -> DataFrame:
    """A field of JSON text; a missing field is NULL."""
    record = F.parse_json("props")
    fields = {"k": ("k", "bigint"), "unknown": ("unknown", "string")}
    return views.events(spark, folder).select("event_id", *renamed_fields(record, fields))


# Streaming


def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Orders through landing files and the bronze stream, run twice; every row arrives once."""
    root = workspace(spark, "bronze_ingest")
    landing.write_landing(views.orders(spark, folder), root, "orders", FIRST_LOAD)
    for _ in range(2):
        load_bronze(
            spark, f"{root}/orders", stored_schema("orders"), f"{root}/bronze", f"{root}/checkpoint", FIRST_LOAD
        )
    fields = parse_schema(landing_schema("orders").json())
    return project_registered(read_bronze(spark, f"{root}/bronze"), fields).drop("schema_url")


def _bronze_of_states(spark: SparkSession, folder: str, name: str) -> str:
    """Bronze orders landed in two batches: as first seen, then the updated ones."""
    root = workspace(spark, name)
    landing.write_landing(views.orders_first_seen(spark, folder), root, "orders", FIRST_LOAD)
    landing.write_landing(views.orders_updated(spark, folder), root, "orders", SECOND_LOAD)
    load_bronze(spark, f"{root}/orders", stored_schema("orders"), f"{root}/bronze", f"{root}/checkpoint", FIRST_LOAD)
    return root


def _delivered(spark: SparkSession, current: str) -> DataFrame:
    rows = spark.read.parquet(current)
    status, spent = ("status", ("status", "string")), ("spent", ("spent", "bigint"))
    typed = rows.select(*renamed_fields(F.col("parquet_raw"), dict([status, spent])), "md5")
    return typed.groupBy("status").agg(F.count(F.lit(1)).alias("rows"), F.sum("spent").alias("spent"))


def delta_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All micro-batches together hold every bronze row once, also after a second, empty run."""
    root = _bronze_of_states(spark, folder, "delta_batches")
    for _ in range(2):
        take_current(spark, f"{root}/bronze", f"{root}/current", f"{root}/taken", max_files=1)
    return _delivered(spark, f"{root}/current")


def independent_readers(spark: SparkSession, folder: str) -> DataFrame:
    """Two consumers of one table, each with its own position, see all of it."""
    root = _bronze_of_states(spark, folder, "independent_readers")
    rows = []
    for consumer in ("status", "fact"):
        take_current(spark, f"{root}/bronze", f"{root}/current_{consumer}", f"{root}/taken_{consumer}")
        rows.append(_delivered(spark, f"{root}/current_{consumer}").withColumn("consumer", F.lit(consumer)))
    return reduce(DataFrame.unionByName, rows)


# Deduplication


def _event_hash(spark: SparkSession, folder: str) -> DataFrame:
    return views.events(spark, folder).withColumn("md5", row_hash(["user_id", "event_type", "props"]))


def dedup_md5(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the same user, type and properties are one record; the earliest survives."""
    return dedup.first_per_hash(_event_hash(spark, folder), order=["ts", "event_id"])


def dedup_window(spark: SparkSession, folder: str) -> DataFrame:
    window = watermark.load_window("ts", EVENTS_FROM, EVENTS_UNTIL, "left")
    first = dedup.first_per_hash(_event_hash(spark, folder).where(window), order=["ts", "event_id"])
    fields = renamed_fields(F.parse_json("props"), {"k": ("k", "bigint")})
    return first.select("event_id", "user_id", F.col("event_type").alias("status"), F.col("ts").alias("ordered_at"), *fields, "md5")


# Contracts and keys


def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Sales rows whose user is not in the users table break the NOT NULL user columns."""
    sales = incremental.joined_rows(views.orders(spark, folder), views.users_in_credit(spark, folder))
    return contracts.null_breaches(sales, source_schema("sales"))


def json_contract(spark: SparkSession, folder: str) -> DataFrame:
    def records(rows: DataFrame, name: str) -> DataFrame:
        text = landing.timestamps_as_text(rows)
        return text.select(F.lit(name).alias("record_set"), "id", F.to_json(F.struct("*")).alias("record"))

    props = views.events(spark, folder).select(
        F.lit("props").alias("record_set"), F.col("event_id").alias("id"), F.col("props").alias("record")
    )
    checked = [
        contracts.validate_records(records(views.users(spark, folder), "users"), "record", contracts.USERS_RECORD),
        contracts.validate_records(records(views.orders(spark, folder), "orders"), "record", contracts.ORDERS_RECORD),
        contracts.validate_records(props, "record", PROPS_RECORD),
    ]
    return reduce(DataFrame.unionByName, checked).select(
        "record_set", "id", "valid", "message", F.array_join("breaches", "; ").alias("breaches")
    )


def pk_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    delivered = views.orders_first_seen(spark, folder).unionByName(views.orders_updated(spark, folder))
    return constraints.duplicate_keys(delivered, "id")


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    orders = views.orders(spark, folder).select("id", "id_user")
    return constraints.orphans(orders, "id_user", views.users_in_credit(spark, folder), "id")


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return keys.with_surrogate_keys(views.orders(spark, folder).select("id", "status"), by=["id"], first=1001)


# Merges and slowly changing dimensions


def scd1_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return merge.upsert(views.orders_first_seen(spark, folder), views.orders_updated(spark, folder), "id")


def silver_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze to silver in two loads; the second delivers the updated orders twice."""
    first = _raw(views.orders_first_seen(spark, folder), "orders").withColumn("created_at", ntz(FIRST_LOAD))
    updated = _raw(views.orders_updated(spark, folder), "orders").withColumn("created_at", ntz(SECOND_LOAD))
    bronze = first.unionByName(updated).unionByName(updated)
    state = None
    for low, high in ((SILVER_FLOOR, FIRST_LOAD), (FIRST_LOAD, SECOND_LOAD)):
        loaded = bronze.where(watermark.load_window("created_at", low, high, "right"))
        batch = dedup.first_per_hash(loaded, order=["created_at"]).select(
            *renamed_fields(F.col("parquet_raw"), ORDER_FIELDS)
        )
        state = changes.upsert_silver(state, batch, "order_id", "updated_at", "ordered_at")
    return state


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A stage as a written table: read many times, computed once."""
    return create_or_replace(df, workspace(spark, name))


def scd2_dim_users(spark: SparkSession, folder: str) -> DataFrame:
    """All users, then the updated ones."""
    first = _stored(spark, scd.versions(views.users(spark, folder), scd.DIM_USERS, FIRST_LOAD), "dim_users")
    batch, next_key = views.users_updated(spark, folder), keys.next_key(first)
    return scd.apply_scd2(first, batch, scd.DIM_USERS, SECOND_LOAD, first_key=next_key, effective_slice=True)


def _dim_status_first(spark: SparkSession, folder: str) -> DataFrame:
    first = scd.versions(views.orders_first_seen(spark, folder), scd.DIM_STATUS, FIRST_LOAD)
    return _stored(spark, first, "dim_status")


def _second_status_load(spark: SparkSession, folder: str, batch: DataFrame, **options) -> DataFrame:
    first = _dim_status_first(spark, folder)
    next_key = keys.next_key(first)
    return scd.apply_scd2(
        first, batch, scd.DIM_STATUS, SECOND_LOAD, first_key=next_key, effective_slice=True, **options
    )


def scd2_dim_status(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as first seen, then the updated ones."""
    return _second_status_load(spark, folder, views.orders_updated(spark, folder))


def scd2_close(spark: SparkSession, folder: str) -> DataFrame:
    return merge.close_versions(_dim_status_first(spark, folder), views.orders_updated(spark, folder), "id")


def scd2_only_changed(spark: SparkSession, folder: str) -> DataFrame:
    """Every order delivered again in its last state: only a new status opens a version."""
    return _second_status_load(spark, folder, views.orders(spark, folder), only_changed=True)


def scd2_valid_to(spark: SparkSession, folder: str) -> DataFrame:
    return scd.with_valid_to(scd2_dim_status(spark, folder))


# Facts and the wide table


def _dimensions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    users = _stored(spark, scd2_dim_users(spark, folder), "dim_users")
    return users, _stored(spark, scd2_dim_status(spark, folder), "dim_status")


def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_orders(views.orders(spark, folder), *_dimensions(spark, folder))


def fact_orders_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """As first written: every version of a user and of a status adds a row."""
    orders = views.orders_first_seen(spark, folder)
    return star.fact_orders(orders, *_dimensions(spark, folder), effective=False)


def _sales(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    return incremental.joined_rows(orders, views.users(spark, folder))


def obt_first_run(spark: SparkSession, folder: str) -> DataFrame:
    sales = _sales(spark, folder, views.orders_first_seen(spark, folder))
    return wide.load_wide(None, sales, FIRST_LOAD, as_written=True)


def obt_second_run(spark: SparkSession, folder: str) -> DataFrame:
    updated = _sales(spark, folder, views.orders_updated(spark, folder))
    return wide.load_wide(obt_first_run(spark, folder), updated, SECOND_LOAD, as_written=True)


def kimball_load(spark: SparkSession, folder: str) -> DataFrame:
    """The star model end to end in two runs; the facts with the versions they point at."""
    warehouse = StarWarehouse(spark, workspace(spark, "kimball_load"), stop_on_failure=False)
    warehouse.run(views.users(spark, folder), views.orders_as_of(spark, folder, WATERMARK), FIRST_LOAD)
    warehouse.run(views.users_last_state(spark, folder), views.orders(spark, folder), SECOND_LOAD)
    return warehouse.fact_orders.read()


def obt_load(spark: SparkSession, folder: str) -> DataFrame:
    """The wide model end to end in two runs; the tag with the place of the run is left out."""
    warehouse = WideWarehouse(spark, workspace(spark, "obt_load"), stop_on_failure=False)
    users = views.users(spark, folder)
    warehouse.run(users, views.orders_as_of(spark, folder, WATERMARK), FIRST_LOAD)
    warehouse.run(users, views.orders(spark, folder), SECOND_LOAD)
    return warehouse.fact_sales.read().drop("schema_url")


def landing_retry(spark: SparkSession, folder: str) -> DataFrame:
    """Users through landing and bronze, with the first batch run three times: each user arrives once."""
    warehouse = Warehouse(spark, workspace(spark, "landing_retry"), [])
    users = views.users(spark, folder)
    known = users.where(F.col("created_at") <= ntz(USERS_UNTIL))
    for source, at in ((known, FIRST_LOAD), (users, FIRST_LOAD), (users, FIRST_LOAD), (users, SECOND_LOAD)):
        warehouse.land("users", incremental.incremental_rows(source, warehouse.watermark("users", at)), at)
        warehouse.ingest(["users"], at)
    return read_bronze(spark, f"{warehouse.root}/bronze/users").select(*renamed_fields(F.col("parquet_raw"), USER_FIELDS))


def repeated_load(spark: SparkSession, folder: str) -> DataFrame:
    """The star model, run three times over one source whose times have fractions of a second."""
    warehouse = StarWarehouse(spark, workspace(spark, "repeated_load"), stop_on_failure=False)
    users, orders = (
        source(spark, folder).withColumn("created_at", F.col("created_at") + F.expr("interval 500 millisecond"))
        for source in (views.users, views.orders)
    )
    for at in (FIRST_LOAD, SECOND_LOAD, THIRD_LOAD):
        warehouse.run(users, orders, at)
    return warehouse.fact_orders.read()


def landing_crash(spark: SparkSession, folder: str) -> DataFrame:
    """The star model behind its gate. The second extract stops between a landed folder and its record, the load is
    scheduled apart, and the next run comes at a later time: each order is one fact."""
    warehouse = StarWarehouse(spark, workspace(spark, "landing_crash"))
    people = views.users(spark, folder).where(F.col("age") <= OLDEST_AUDITED)
    known = F.col("id_user") % AGES <= OLDEST_AUDITED
    orders = views.orders(spark, folder).where(known)
    warehouse.run(people, views.orders_as_of(spark, folder, WATERMARK).where(known), FIRST_LOAD)
    batch = incremental.incremental_rows(orders, warehouse.watermark("orders", SECOND_LOAD))
    landing.write_landing(batch, f"{warehouse.root}/landing", "orders", SECOND_LOAD)
    warehouse.load(SECOND_LOAD)
    warehouse.run(people, orders, THIRD_LOAD)
    return warehouse.fact_orders.read()


def rejected_load(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose users have not all come: the load counts the orphans and commits no fact. The missing users land, and
    the next load takes the same orders over."""
    warehouse = StarWarehouse(spark, workspace(spark, "rejected_load"), stop_on_failure=False)
    warehouse.extract(views.users_in_credit(spark, folder), views.orders(spark, folder), FIRST_LOAD)
    try:
        warehouse.load(FIRST_LOAD)
    except StreamingQueryException as stopped:
        if KeyViolation.__name__ not in str(stopped):
            raise
    warehouse.land("users", views.users_updated(spark, folder), SECOND_LOAD)
    warehouse.load(SECOND_LOAD)
    return warehouse.fact_orders.read()


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Users of whom some are committed after a read that has passed their times; a third read lands nothing."""
    warehouse = Warehouse(spark, workspace(spark, "late_rows"), [], overlap=LATE_BY)
    users = views.users(spark, folder)
    newest = watermark.high_water_value(users, "created_at")
    late = (F.col("id") % 7 == 0) & (F.col("created_at") > ntz(newest - LATE_BY))
    for source, at in ((users.where(~late), FIRST_LOAD), (users, SECOND_LOAD), (users, THIRD_LOAD)):
        warehouse.extract_table("users", source, at)
    return landing.read_landing(spark, f"{warehouse.root}/landing", "users", stored_schema("users")).drop("schema_url")


def schema_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Landed files of two versions of a contract, in one typed table: a field that a version lacks is NULL."""
    warehouse = Warehouse(spark, workspace(spark, "schema_versions"), [])
    warehouse.publish_contracts("users")
    warehouse.publish_contract("users", USERS_SECOND_VERSION, "2_0")
    warehouse.land("users", views.users_in_credit(spark, folder), FIRST_LOAD)
    moved = views.users_updated(spark, folder).withColumnRenamed("address", "segment")
    warehouse.land("users", moved, SECOND_LOAD, "2_0")
    warehouse.ingest(["users"], SECOND_LOAD)
    bronze = read_bronze(spark, f"{warehouse.root}/bronze/users")
    return deduplicated_extract(bronze, warehouse.versions("users")).drop("schema_url")


# Audit


def dq_failure_log(spark: SparkSession, folder: str) -> DataFrame:
    """The stored failures of two runs, under one numbering, with their rules from the stored catalogue."""
    warehouse = Warehouse(spark, workspace(spark, "dq_failure_log"), audit.star_rules(AUDITED_STATUSES), stop_on_failure=False)
    warehouse.publish_contracts("users", "orders")
    runs = (
        (FIRST_LOAD, views.users(spark, folder), views.orders_as_of(spark, folder, WATERMARK)),
        (SECOND_LOAD, views.users_last_state(spark, folder), views.orders(spark, folder)),
    )
    for at, *sources in runs:
        for entity, source in zip(("users", "orders"), sources):
            warehouse.land(entity, incremental.incremental_rows(source, warehouse.watermark(entity, at)), at)
        warehouse.ingest(("users", "orders"), at)
        for entity in ("users", "orders"):
            warehouse.refresh(entity, at, lambda extract, batch_id: None)
    catalogue = warehouse.rule_catalogue().withColumnRenamed("id", "id_dim_tests")
    return warehouse.failure_log().join(catalogue, "id_dim_tests").drop("test_sql")


def _audit_failures(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"users_extract_cast": views.users(spark, folder), "orders_extract_cast": views.orders(spark, folder)}
    return audit.run_audit(tables, audit.star_rules(AUDITED_STATUSES), SECOND_LOAD)


def dq_gate(spark: SparkSession, folder: str) -> DataFrame:
    return audit.gate(_audit_failures(spark, folder))


def dq_sales(spark: SparkSession, folder: str) -> DataFrame:
    sales = incremental.joined_rows(views.orders(spark, folder), views.users_in_credit(spark, folder))
    return audit.run_audit({"sales_extract_cast": sales}, audit.wide_rules(AUDITED_STATUSES), SECOND_LOAD)


# Change data


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    """From the orders known at one time to those kept later: new, updated and removed rows."""
    old = views.orders_as_of(spark, folder, WATERMARK)
    new = views.orders(spark, folder).where(F.col("created_at") >= ntz(KEPT_SINCE))
    return changes.change_feed(old, new, "id")


def _feeds(spark: SparkSession, first: DataFrame, last: DataFrame, key: str) -> list[DataFrame]:
    """Feeds of two silver loads, each written once as several gold tables read it."""
    feeds = (changes.change_feed(first.limit(0), first, key), changes.change_feed(first, last, key))
    return [_stored(spark, feed, "feed") for feed in feeds]


def _order_feeds(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The orders known at one time, then all in their last state."""
    first = orders_to_silver(views.orders_as_of(spark, folder, WATERMARK))
    return _feeds(spark, first, orders_to_silver(views.orders(spark, folder)), "order_id")


def _user_feeds(spark: SparkSession, folder: str) -> list[DataFrame]:
    first = users_to_silver(views.users(spark, folder))
    return _feeds(spark, first, users_to_silver(views.users_last_state(spark, folder)), "user_id")


def _follow(spark: SparkSession, feeds: list[DataFrame], dim: scd.Dimension) -> DataFrame:
    return _states(spark, feeds, dim)[1]


def _states(spark: SparkSession, feeds: list[DataFrame], dim: scd.Dimension) -> tuple[DataFrame, DataFrame]:
    """A dimension after each of two feeds."""
    first = changes.apply_feed_scd2(dim.empty(spark), feeds[0], dim, FIRST_LOAD, effective_slice=True)
    stored = _stored(spark, first, dim.name)
    next_key = keys.next_key(stored, dim.surrogate)
    return stored, changes.apply_feed_scd2(stored, feeds[1], dim, SECOND_LOAD, first_key=next_key, effective_slice=True)


def cdc_scd2(spark: SparkSession, folder: str) -> DataFrame:
    return _follow(spark, _order_feeds(spark, folder), changes.DIM_ORDERSTATUS)


def cdc_dim_user(spark: SparkSession, folder: str) -> DataFrame:
    return _follow(spark, _user_feeds(spark, folder), changes.DIM_USER)


def cdc_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that entered with either load, each with the versions effective after it."""
    feeds = _order_feeds(spark, folder)
    status = _states(spark, feeds, changes.DIM_ORDERSTATUS)
    users = _states(spark, _user_feeds(spark, folder), changes.DIM_USER)
    first = _stored(spark, changes.fact_from_feed(feeds[0], status[0], users[0]), "facts")
    last = [_stored(spark, df, name) for df, name in ((status[1], "dim_orderstatus"), (users[1], "dim_user"))]
    return first.unionByName(changes.fact_from_feed(feeds[1], *last, first_key=keys.next_key(first, "id")))


def cdc_load(spark: SparkSession, folder: str) -> DataFrame:
    """The change-driven model end to end in two loads, from landing files to gold."""
    return _change_warehouse(spark, folder, "cdc_load").fact_orders.read()


def cdc_catch_up(spark: SparkSession, folder: str) -> DataFrame:
    """Two silver commits that gold takes over at once: the facts are those of two plain loads, keys included."""
    warehouse = ChangeWarehouse(spark, workspace(spark, "cdc_catch_up"))
    for at, users, orders in (
        (FIRST_LOAD, views.users(spark, folder), views.orders_as_of(spark, folder, WATERMARK)),
        (SECOND_LOAD, views.users_updated(spark, folder), views.orders(spark, folder)),
    ):
        warehouse.upsert(users_to_silver(users), orders_to_silver(orders), at)
    warehouse.refresh()
    return warehouse.fact_orders.read()


def cdc_silver_window(spark: SparkSession, folder: str) -> DataFrame:
    """The stored silver orders of both loads with their load times."""
    return _change_warehouse(spark, folder, "cdc_silver_window").orders.current()


def _change_warehouse(spark: SparkSession, folder: str, name: str) -> ChangeWarehouse:
    warehouse = ChangeWarehouse(spark, workspace(spark, name))
    loads = (
        (FIRST_LOAD, views.users(spark, folder), views.orders_as_of(spark, folder, WATERMARK)),
        (SECOND_LOAD, views.users_updated(spark, folder), views.orders(spark, folder)),
    )
    for as_of, users, orders in loads:
        warehouse.land("users", users, as_of)
        warehouse.land("orders", incremental.incremental_rows(orders, warehouse.watermark("orders", as_of)), as_of)
        warehouse.load(as_of)
    return warehouse


QUERIES: dict[str, Query] = {
    "incremental_extract": incremental_extract,
    "obt_extract": obt_extract,
    "watermark_floor": watermark_floor,
    "watermark_window": watermark_window,
    "landing_scan": landing_scan,
    "staged_file": staged_file,
    "tag_schema": tag_schema,
    "timestamps_as_text": timestamps_as_text,
    "row_hash": row_hashes,
    "bronze_lineage": bronze_lineage,
    "extract_cast": extract_cast,
    "extract_fixed": extract_fixed,
    "extract_props": extract_props,
    "bronze_ingest": bronze_ingest,
    "delta_batches": delta_batches,
    "independent_readers": independent_readers,
    "dedup_md5": dedup_md5,
    "dedup_window": dedup_window,
    "contract_violations": contract_violations,
    "json_contract": json_contract,
    "pk_duplicates": pk_duplicates,
    "fk_orphans": fk_orphans,
    "surrogate_keys": surrogate_keys,
    "scd1_upsert": scd1_upsert,
    "silver_upsert": silver_upsert,
    "scd2_close": scd2_close,
    "scd2_dim_users": scd2_dim_users,
    "scd2_dim_status": scd2_dim_status,
    "scd2_only_changed": scd2_only_changed,
    "scd2_valid_to": scd2_valid_to,
    "fact_orders": fact_orders,
    "fact_orders_fanout": fact_orders_fanout,
    "obt_first_run": obt_first_run,
    "obt_second_run": obt_second_run,
    "kimball_load": kimball_load,
    "obt_load": obt_load,
    "landing_retry": landing_retry,
    "repeated_load": repeated_load,
    "landing_crash": landing_crash,
    "rejected_load": rejected_load,
    "late_rows": late_rows,
    "schema_versions": schema_versions,
    "dq_failure_log": dq_failure_log,
    "dq_failures": _audit_failures,
    "dq_gate": dq_gate,
    "dq_sales": dq_sales,
    "change_feed": change_feed,
    "cdc_scd2": cdc_scd2,
    "cdc_dim_user": cdc_dim_user,
    "cdc_fact": cdc_fact,
    "cdc_load": cdc_load,
    "cdc_silver_window": cdc_silver_window,
    "cdc_catch_up": cdc_catch_up,
}
