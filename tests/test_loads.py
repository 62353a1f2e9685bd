"""Snapshot tables, streaming ingest with restarts, and the loads end to end on the seed rows."""

import os

import pytest
from pyspark.sql import functions as F

from seed import LATER, PLACED, RUN_1, RUN_2, RUN_3, orders, rows, users
from tidemark.operators.audit import AuditFailed
from tidemark.operators.changes import change_feed
from tidemark.operators.scd import DIM_STATUS, changed_only, scd2_parts
from tidemark.operators.star import fact_orders
from tidemark.plans.cdc import ChangeWarehouse, orders_to_silver, users_to_silver
from tidemark.plans.kimball import StarWarehouse
from tidemark.plans.obt import WideWarehouse
from tidemark.session import plan_bytes, workspace
from tidemark.sources import landing
from tidemark.sources.contracts import stored_schema
from tidemark.streaming import bronze, delta
from tidemark.tables import KeyViolation, SnapshotTable, create_or_replace

MOVED = (1, "francisco", 35, "new road 1", PLACED, LATER)
SHIPPED = (1, 1, 30, "shipped", PLACED, LATER)
NEW_ORDER = (4, 2, 70, "processing", LATER, None)


def dim_table(spark, path, partitions=4):
    return SnapshotTable(spark, str(path), DIM_STATUS.schema, "id", "sk", partitions)


def commit(table, batch, batch_id, as_of=RUN_1):
    first = table.next_key()
    return table.merge(batch, batch_id, lambda stored: scd2_parts(stored, batch, DIM_STATUS, as_of, first, effective_slice=True))


def test_commits_versions_and_batch_ids(spark, tmp_path):
    table = dim_table(spark, tmp_path / "dim")
    assert table.version == 0 and table.read().count() == 0 and table.next_key() == 1
    batch = spark.range(100).select("id", F.lit("a").alias("status"))
    assert commit(table, batch, "b1")
    assert not commit(table, batch, "b1")
    assert commit(table, batch.where("id < 10").withColumn("status", F.lit("b")), "b2", RUN_2)
    fresh = dim_table(spark, tmp_path / "dim", partitions=None)
    assert fresh.version == 2 and fresh.partitions == 4 and fresh.next_key() == 111
    assert (fresh.current().count(), fresh.history().count()) == (100, 10)
    assert {r.status for r in fresh.current().where("id < 10").collect()} == {"b"}
    assert {r.status for r in fresh.current(version=1).collect()} == {"a"}
    assert fresh.read().select("sk").distinct().count() == 110


def scanned(df):
    """Partition folders that a plan's scans read."""
    return {int(f.split("part=")[1].split("/")[0]) for f in df.inputFiles()}


def test_a_small_batch_reads_and_writes_the_partitions_it_touches(spark, tmp_path):
    table = dim_table(spark, tmp_path / "dim", partitions=64)
    seed = spark.range(5000).select("id", F.lit("a").alias("status"))
    commit(table, seed, "b1")
    assert table.commits[0].parts == list(range(64))
    batch, read = seed.where("id = 77").withColumn("status", F.lit("b")), []

    def build(stored):
        read.append(scanned(stored))
        return scd2_parts(stored, batch, DIM_STATUS, RUN_2, table.next_key(), effective_slice=True)

    assert table.merge(batch, "b2", build) and not table.merge(batch, "b2", build)
    (part,) = read[0]
    assert len(read) == 1 and table.commits[1].parts == table.commits[1].touched == [part]
    written = os.listdir(f"{table.commits[1].folder}/slice=current")
    assert [f for f in written if f.startswith("part=")] == [f"part={part}"]
    fresh = dim_table(spark, tmp_path / "dim", partitions=None)
    assert fresh.version == 2 and fresh.current().count() == 5000 and fresh.history().count() == 1
    assert rows(fresh.current().where("id = 77").select("sk", "status")) == [(5001, "b")]
    assert fresh.current(version=1).where("status = 'a'").count() == 5000
    # A batch without rows touches nothing.
    assert commit(fresh, seed.where("id < 0"), "b3") and fresh.commits[-1].touched == [] and fresh.current().count() == 5000


def test_a_merge_moves_no_stored_row_beside_a_small_batch(spark, tmp_path):
    table = dim_table(spark, tmp_path / "dim")
    seed = spark.range(1000).select("id", F.lit("a").alias("status"))
    commit(table, seed, "b1")
    kept, _ = scd2_parts(table.current(), seed.where("id < 3"), DIM_STATUS, RUN_2, 1001, effective_slice=True)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    stored = plan[: plan.index("Scan parquet")] if plan.index("Scan parquet") < plan.index("Range") else plan
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(id" not in stored


def test_states_of_versions_are_compared(spark, tmp_path):
    table = dim_table(spark, tmp_path / "dim")
    commit(table, spark.range(1000).select("id", F.lit("a").alias("status")), "b1")
    commit(table, spark.range(10).select("id", F.lit("b").alias("status")), "b2", RUN_2)
    assert change_feed(table.current(1), table.current(2), "id").count() == 20
    batch = spark.range(1000).select("id", F.lit("a").alias("status"))
    assert changed_only(batch, table.current(), DIM_STATUS).count() == 10


def test_partitions_follow_the_size(spark, tmp_path, monkeypatch):
    table = dim_table(spark, tmp_path / "dim", partitions=None)
    batch = create_or_replace(spark.range(1000).select("id", F.lit("a").alias("status")), f"{tmp_path}/batch")
    commit(table, batch, "b1")
    assert table.partitions == 1
    commit(table, batch.where("id = 5").withColumn("status", F.lit("b")), "b2", RUN_2)
    assert table.partitions == 1
    monkeypatch.setattr("tidemark.tables.PART_BYTES", plan_bytes(batch) // 8)
    commit(table, batch.where("id < 10").withColumn("status", F.lit("c")), "b3", RUN_3)
    fresh = dim_table(spark, tmp_path / "dim", partitions=None)
    assert fresh.partitions >= 8 and len(fresh.commits[-1].touched) == fresh.partitions
    assert fresh.current().count() == 1000 and fresh.history().count() == 11
    # The type of a batch's key does not move a row to another partition.
    commit(fresh, spark.sql("select int(7) id, 'd' status"), "b4", RUN_3)
    assert fresh.current().count() == 1000 and rows(fresh.current().where("id = 7").select("status")) == [("d",)]


def test_append_only_table(spark, tmp_path):
    table = dim_table(spark, tmp_path / "fact")
    row = spark.sql("select 5L sk, 1L id, 's' status, timestamp_ntz'2020-01-01' valid_from, true is_effective")
    assert table.append(row, "a") and table.append(row, "b") and not table.append(row, "b")
    assert table.read().count() == 2 and table.current().count() == 0 and table.next_key() == 6


def test_commits_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], DIM_STATUS.schema)
    fact = dim_table(spark, tmp_path / "fact")
    assert fact.append(none, "a") and fact.read().count() == 0 and fact.next_key() == 1
    dim = dim_table(spark, tmp_path / "dim")
    seed = spark.range(100).select("id", F.lit("a").alias("status"))
    assert commit(dim, seed.where("id < 0"), "b1") and dim.read().count() == 0
    assert commit(dim, seed, "b2") and dim.read().count() == 100
    assert commit(dim, seed.where("id % 7 = 9"), "b3") and dim.read().count() == 100
    assert dim.current().count() == 100 and dim.version == 3


def test_a_batch_of_updates_only_adds_no_fact(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path))
    warehouse.run(users(spark), orders(spark), RUN_1)
    warehouse.run(users(spark), orders(spark, [SHIPPED]), RUN_2)
    assert warehouse.fact_orders.version == 2 and warehouse.fact_orders.read().count() == 3
    assert warehouse.dim_status.read().count() == 4


def test_a_failed_commit_is_not_seen(spark, tmp_path):
    table = dim_table(spark, tmp_path / "dim")
    commit(table, spark.range(3).select("id", F.lit("a").alias("status")), "b1")
    broken = spark.range(3).select("id", F.lit(None).cast("string").alias("status"))
    with pytest.raises(Exception, match="dim_status.status"):
        commit(table, broken, "b2", RUN_2)
    fresh = dim_table(spark, tmp_path / "dim")
    assert fresh.version == 1 and fresh.read().count() == 3
    assert commit(fresh, broken.withColumn("status", F.lit("c")), "b2", RUN_2) and fresh.read().count() == 6


def test_workspace_is_below_the_shared_folder(spark):
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_bronze_reads_each_file_once_and_keeps_lineage(spark, tmp_path):
    root = str(tmp_path)

    def ingest(at):
        bronze.load_bronze(
            spark, f"{root}/users", stored_schema("users"), f"{root}/bronze", f"{root}/cp", at, max_files=1
        )
        return bronze.read_bronze(spark, f"{root}/bronze")

    landing.write_landing(users(spark).coalesce(1), root, "users", RUN_1)
    assert ingest(RUN_1).count() == 3
    assert ingest(RUN_2).count() == 3
    landing.write_landing(users(spark, [MOVED]), root, "users", RUN_2)
    loaded = ingest(RUN_2)
    assert loaded.count() == 4 and loaded.select("md5").distinct().count() == 4
    first = loaded.where(f"created_at = timestamp_ntz'{RUN_1}'")
    assert [r.metadata_row_number for r in first.orderBy("metadata_row_number").collect()] == [1, 2, 3]
    assert first.select("source").distinct().count() == 1 and ".parquet" in first.first().source


def test_consumers_keep_their_own_position_and_a_failed_batch_comes_again(spark, tmp_path):
    root = str(tmp_path)
    landing.write_landing(users(spark).coalesce(1), root, "users", RUN_1)
    bronze.load_bronze(spark, f"{root}/users", stored_schema("users"), f"{root}/bronze", f"{root}/cp", RUN_1)
    seen = []

    def take(name, fail=False):
        def apply(batch, number):
            seen.append((name, number, batch.count()))
            if fail:
                raise RuntimeError("stop")

        delta.consume(spark, f"{root}/bronze", f"{root}/{name}", apply)

    with pytest.raises(Exception):
        take("first", fail=True)
    take("first")
    take("first")
    take("second")
    assert seen == [("first", 0, 3), ("first", 0, 3), ("second", 0, 3)]
    delta.take_current(spark, f"{root}/bronze", f"{root}/current", f"{root}/taken")
    assert spark.read.parquet(f"{root}/current").count() == 3


def test_star_load_on_the_seed(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path))
    warehouse.run(users(spark), orders(spark), RUN_1)
    assert [t.read().count() for t in (warehouse.dim_users, warehouse.dim_status, warehouse.fact_orders)] == [3, 3, 3]
    assert warehouse.watermark("orders") == PLACED

    # Nothing new: nothing lands, nothing is loaded.
    warehouse.run(users(spark), orders(spark), RUN_2)
    assert [t.version for t in (warehouse.dim_users, warehouse.dim_status, warehouse.fact_orders)] == [1, 1, 1]

    seed_users = [tuple(r) for r in users(spark).where("id > 1").collect()]
    seed_orders = [tuple(r) for r in orders(spark).where("id > 1").collect()]
    warehouse = StarWarehouse(spark, str(tmp_path))  # a new process
    warehouse.run(users(spark, [MOVED, *seed_users]), orders(spark, [SHIPPED, NEW_ORDER, *seed_orders]), RUN_3)
    people = warehouse.dim_users.read()
    assert people.count() == 4
    assert {r.id: r.address for r in people.where("is_effective").collect()}[1] == "new road 1"
    states = warehouse.dim_status.read()
    assert rows(states.where("is_effective").select("id", "status")) == [
        (1, "shipped"), (2, "processing"), (3, "processing"), (4, "processing"),
    ]
    facts = warehouse.fact_orders.read()
    assert sorted(r.id for r in facts.collect()) == [1, 2, 3, 4]
    assert sorted(r.sk for r in facts.collect()) == [1, 2, 3, 4]
    assert warehouse.watermark("users") == LATER


def test_a_source_without_rows_lands_nothing(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path))
    warehouse.run(users(spark), orders(spark).limit(0), RUN_1)
    assert (warehouse.dim_users.read().count(), warehouse.fact_orders.read().count()) == (3, 0)
    warehouse.run(users(spark), orders(spark), RUN_2)
    assert (warehouse.dim_users.read().count(), warehouse.fact_orders.read().count()) == (3, 3)


def test_star_load_in_several_micro_batches(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path))
    warehouse.extract(users(spark).repartition(3), orders(spark).repartition(3), RUN_1)
    warehouse.load(RUN_1, max_files=1)
    assert warehouse.dim_status.version >= 1
    assert sorted(r.sk for r in warehouse.fact_orders.read().collect()) == [1, 2, 3]
    assert sorted(r.sk for r in warehouse.dim_users.read().collect()) == [1, 2, 3]


def test_star_load_stops_at_the_gate_and_goes_on_after_it(spark, tmp_path):
    old = users(spark, [(1, "a", 101, "x", PLACED, None)])
    batch = orders(spark, [(1, 1, 5, "processing", PLACED, None)])
    strict = StarWarehouse(spark, str(tmp_path))
    with pytest.raises(Exception, match=AuditFailed.__name__):
        strict.run(old, batch, RUN_1)
    assert strict.dim_users.version == 0
    failures = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/data_quality/fact_errors")
    assert [(r.id_dim_tests, r.amount_records_failing) for r in failures.collect()] == [(2, 1)]
    # The batch was not consumed: with the gate open the same rows are loaded.
    StarWarehouse(spark, str(tmp_path), stop_on_failure=False).load(RUN_2)
    again = StarWarehouse(spark, str(tmp_path))
    assert again.dim_users.read().count() == 1 and again.fact_orders.read().count() == 1


def test_wide_load_on_the_seed(spark, tmp_path):
    warehouse = WideWarehouse(spark, str(tmp_path))
    warehouse.run(users(spark), orders(spark), RUN_1)
    assert warehouse.fact_sales.read().count() == 3
    warehouse.run(users(spark), orders(spark, [SHIPPED, NEW_ORDER]), RUN_2)
    sales = warehouse.fact_sales.read()
    assert sales.count() == 5 and sales.where("is_effective").count() == 4
    assert sales.columns[:6] == ["order_id", "order_id_user", "order_spent", "order_status", "user_id", "user_name"]
    closed = sales.where("not is_effective").first()
    assert (closed.order_id, closed.order_status, closed.schema_name) == (1, "processing", "sales")


def test_wide_load_rejects_an_order_without_its_user(spark, tmp_path):
    warehouse = WideWarehouse(spark, str(tmp_path))
    with pytest.raises(Exception, match="NULL in NOT NULL column user_id"):
        warehouse.run(users(spark), orders(spark, [(9, 99, 1, "processing", PLACED, None)]), RUN_1)


def test_change_driven_load_on_the_seed(spark, tmp_path):
    warehouse = ChangeWarehouse(spark, str(tmp_path))

    def load(people, batch, at):
        warehouse.upsert(users_to_silver(people), orders_to_silver(batch), at)
        warehouse.refresh(at)

    load(users(spark), orders(spark), RUN_1)
    load(users(spark), orders(spark), RUN_1)  # the same batch again
    assert (warehouse.dim_user.read().count(), warehouse.dim_orderstatus.read().count()) == (3, 3)
    assert warehouse.fact_orders.read().count() == 3
    load(users(spark, [MOVED]), orders(spark, [SHIPPED, NEW_ORDER]), RUN_2)
    assert warehouse.orders.current().count() == 4
    assert warehouse.dim_user.read().count() == 4
    states = warehouse.dim_orderstatus.read()
    assert states.count() == 5 and states.where("is_effective").count() == 4
    facts = warehouse.fact_orders.read()
    assert sorted((r.id, r.order_id) for r in facts.collect())[-1] == (4, 4)
    assert facts.count() == 4


def test_a_repeated_batch_neither_loses_nor_doubles_rows(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path))
    late = (4, "anna", 40, "x", LATER, None)
    warehouse.land("users", users(spark), RUN_1)  # then the run stops before the orders
    everyone = users(spark).unionByName(users(spark, [late]))
    warehouse.run(everyone, orders(spark), RUN_1)
    assert warehouse.dim_users.read().count() == 3 and warehouse.fact_orders.read().count() == 3
    warehouse.run(everyone, orders(spark), RUN_2)
    assert warehouse.dim_users.read().count() == 4 and warehouse.fact_orders.read().count() == 3


def test_a_landed_batch_without_its_record_is_not_landed_again(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path))
    landing.write_landing(orders(spark), f"{tmp_path}/landing", "orders", RUN_1)  # stopped before the record
    warehouse.ingest(["orders"], RUN_1)
    warehouse.run(users(spark), orders(spark), RUN_1)
    assert warehouse.fact_orders.read().count() == 3 and warehouse.watermark("orders") == PLACED


def test_an_unfinished_attempt_is_not_read(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path))
    warehouse.land("users", users(spark), RUN_1)
    attempt = f"{tmp_path}/landing{landing.ATTEMPTS}/users-x/part.parquet"
    landing.tag_schema(landing.timestamps_as_text(users(spark)), "users", "r").write.parquet(attempt)
    warehouse.ingest(["users"], RUN_1)
    assert bronze.read_bronze(spark, f"{tmp_path}/bronze/users").count() == 3


def test_a_file_with_an_old_time_is_loaded(spark, tmp_path):
    root = str(tmp_path)
    landing.write_landing(users(spark), root, "users", RUN_1)
    load = lambda: bronze.load_bronze(spark, f"{root}/users", stored_schema("users"), f"{root}/bronze", f"{root}/cp", RUN_1)
    load()
    path = landing.write_landing(users(spark, [MOVED]), root, "users", RUN_2)["path"]
    for name in os.listdir(path):
        os.utime(f"{path}/{name}", (1_000_000_000, 1_000_000_000))
    load()
    assert bronze.read_bronze(spark, f"{root}/bronze").count() == 4


def test_a_lost_checkpoint_stops_the_load(spark, tmp_path):
    StarWarehouse(spark, str(tmp_path)).run(users(spark), orders(spark), RUN_1)
    os.rename(f"{tmp_path}/checkpoints/refresh_users", f"{tmp_path}/elsewhere")
    with pytest.raises(RuntimeError, match="restore it"):
        StarWarehouse(spark, str(tmp_path)).run(users(spark), orders(spark), RUN_2)


def test_failure_ids_are_unique_over_entities_and_batches(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path), stop_on_failure=False)
    old = (1, "x", 150, "a", PLACED, None)
    warehouse.run(users(spark, [old]), orders(spark, [(1, 1, 0, "lost", PLACED, None)]), RUN_1)
    warehouse.run(users(spark, [(2, "", 20, "a", LATER, None)]), orders(spark), RUN_2)
    log = warehouse.failure_log().orderBy("id").collect()
    assert [(r.id, r.id_dim_tests) for r in log] == [(1, 2), (2, 4), (3, 5), (4, 3)]
    assert {r.id for r in warehouse.rule_catalogue().collect()} == {1, 2, 3, 4, 5}


def test_an_order_of_an_unknown_user_stops_the_feed_driven_fact(spark, tmp_path):
    warehouse = ChangeWarehouse(spark, str(tmp_path))
    unknown = orders(spark, [(9, 99, 5, "processing", PLACED, None)])
    warehouse.upsert(users_to_silver(users(spark)), orders_to_silver(unknown), RUN_1)
    with pytest.raises(Exception, match="fact_orders.orderuser_id"):
        warehouse.refresh(RUN_1)


def test_change_driven_load_from_landing_to_gold(spark, tmp_path):
    warehouse = ChangeWarehouse(spark, str(tmp_path))
    for at in (RUN_1, RUN_1, RUN_2):  # a repeated run and one without news change nothing
        warehouse.run(users(spark), orders(spark), at)
        assert [t.version for t in (warehouse.users, warehouse.orders, warehouse.fact_orders)] == [1, 1, 1]
    everyone = users(spark, [MOVED]).unionByName(users(spark).where("id > 1"))
    all_orders = orders(spark, [SHIPPED, NEW_ORDER]).unionByName(orders(spark).where("id > 1"))
    ChangeWarehouse(spark, str(tmp_path)).run(everyone, all_orders, RUN_3)
    warehouse = ChangeWarehouse(spark, str(tmp_path))
    silver = warehouse.orders.current()
    assert silver.count() == 4 and silver.where(f"copied_at = timestamp_ntz'{RUN_3}' and dbt_at = copied_at").count() == 2
    assert warehouse.fact_orders.read().count() == 4 and warehouse.dim_user.read().count() == 4
    feed = spark.read.parquet(f"{tmp_path}/silver/orders_deduplicated/feed/000002")
    assert sorted((r.order_id, r.action) for r in feed.collect()) == [(1, "DELETE"), (1, "INSERT"), (4, "INSERT")]


def test_load_times_alone_are_no_change(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], "k int, v string, t int")
    new = spark.createDataFrame([(1, "a", 2), (2, "c", 2), (4, None, 2)], "k int, v string, t int")
    found = sorted((r.k, r.action, r.is_update) for r in change_feed(old, new, "k", ignore=["t"]).collect())
    assert found == [(2, "DELETE", True), (2, "INSERT", True), (3, "DELETE", False), (4, "INSERT", False)]


def test_a_repeated_key_is_counted_by_the_write_and_not_committed(spark, tmp_path):
    table = dim_table(spark, tmp_path / "dim")
    commit(table, spark.range(50).select("id", F.lit("a").alias("status")), "b1")
    twice = spark.createDataFrame([(1, 51, "b", 1), (2, 51, "c", 1), (3, 52, "b", 1)], "sk bigint, id bigint, status string, n int")
    rows_of = twice.select("sk", "id", "status", F.lit(None).cast("timestamp_ntz").alias("valid_from"), F.lit(True).alias("is_effective"))
    with pytest.raises(KeyViolation, match="nothing of batch b2 was committed to .*: 1 rows with a repeated id"):
        table.merge(rows_of, "b2", lambda stored: (stored, rows_of))
    assert (table.version, table.read().count()) == (1, 50)
    closed = rows_of.withColumn("is_effective", F.col("sk") != 1)  # several versions of a key, one of them effective
    assert table.merge(closed, "b2", lambda stored: (stored, closed))
    assert (table.current().count(), table.history().count()) == (52, 1)


def test_the_proof_of_keys_moves_no_rows(spark):
    people = spark.range(2000).select("id", F.col("id").alias("sk"), F.lit(True).alias("is_effective"))
    batch = spark.range(5000).select(
        "id", (F.col("id") % 2000).alias("id_user"), F.lit(PLACED).cast("timestamp_ntz").alias("created_at"),
        F.lit(1).alias("spent"), F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    states = spark.range(5000).select("id", F.col("id").alias("sk"), F.lit(True).alias("is_effective"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [fact_orders(batch, people, states, counted=c)._jdf.queryExecution().executedPlan().toString() for c in (False, True)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans[0].count("Exchange ") == plans[1].count("Exchange ") > 0
    assert plans[0].count("Window ") < plans[1].count("Window ")


def test_orphans_and_repeated_orders_are_counted_and_come_again(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path), stop_on_failure=False)
    bad = [(1, 1, 30, "processing", PLACED, None), (1, 1, 31, "processing", PLACED, None), (2, 8, 5, "processing", PLACED, None),
           (3, 9, 5, "processing", PLACED, None)]
    warehouse.extract(users(spark), orders(spark, bad), RUN_1)
    with pytest.raises(Exception, match="2 rows with fact_orders.id_dim_user of no version, 1 rows with a repeated fact_orders.id"):
        warehouse.load(RUN_1)
    assert warehouse.fact_orders.version == 0


def test_a_batch_of_orphans_loads_once_their_users_are_there(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path), stop_on_failure=False)
    warehouse.extract(users(spark, [(1, "francisco", 34, "chalk avenue 23", PLACED, None)]), orders(spark), RUN_1)
    with pytest.raises(Exception, match="KeyViolation.*1 rows with fact_orders.id_dim_user"):
        warehouse.load(RUN_1)
    warehouse.land("users", users(spark, [(3, "john", 20, "salvador square 10", PLACED, None)]), RUN_2)
    warehouse.load(RUN_2)
    assert rows(warehouse.fact_orders.read().select("id", "id_dim_user")) == [(1, 1), (2, 1), (3, 2)]
