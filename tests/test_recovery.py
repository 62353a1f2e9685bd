"""Runs that stop half-way, rows that come late, gold that lags behind, and contracts that change."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from seed import LATER, PLACED, RUN_1, RUN_2, RUN_3, orders, rows, users
from tidemark.plans.cdc import ChangeWarehouse, orders_to_silver, users_to_silver
from tidemark.plans.kimball import StarWarehouse
from tidemark.plans.obt import WideWarehouse
from tidemark.plans.queries import USERS_SECOND_VERSION
from tidemark.plans.stages import Warehouse
from tidemark.sources import landing
from tidemark.sources.registry import RegistryField, deduplicated_extract, widened
from tidemark.streaming.bronze import read_bronze

RUN_4 = "2021-12-13 00:00:00"
SHIPPED = (1, 1, 30, "shipped", PLACED, LATER)


def stop_before_the_record(monkeypatch, run):
    """Runs an extract that stops after a folder was moved to its place and before its record was written."""

    def stopped(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "_record", stopped)
        with pytest.raises(RuntimeError, match="stopped"):
            run()


@pytest.mark.parametrize("max_files", [None, 1])
def test_a_stopped_star_extract_doubles_no_fact(spark, tmp_path, monkeypatch, max_files):
    warehouse = StarWarehouse(spark, str(tmp_path))
    warehouse.land("users", users(spark), RUN_1)
    stop_before_the_record(monkeypatch, lambda: warehouse.land("orders", orders(spark), RUN_1))
    warehouse.load(RUN_1, max_files)  # scheduled on its own
    later = StarWarehouse(spark, str(tmp_path))
    later.run(users(spark), orders(spark), RUN_2)
    later.load(RUN_2, max_files)
    assert later.fact_orders.read().count() == 3 and later.watermark("orders") == PLACED
    assert later.dim_status.read().count() == 3
    later.run(users(spark), orders(spark, [SHIPPED]), RUN_3)
    assert later.dim_status.read().count() == 4 and later.fact_orders.read().count() == 3


def test_folders_that_no_run_loaded_are_loaded_once(spark, tmp_path, monkeypatch):
    warehouse = StarWarehouse(spark, str(tmp_path))
    warehouse.land("users", users(spark), RUN_1)
    stop_before_the_record(monkeypatch, lambda: warehouse.land("orders", orders(spark), RUN_1))
    StarWarehouse(spark, str(tmp_path)).run(users(spark), orders(spark), RUN_2)
    assert warehouse.fact_orders.read().count() == 3


def test_a_stopped_wide_extract_opens_no_false_version(spark, tmp_path, monkeypatch):
    warehouse = WideWarehouse(spark, str(tmp_path))
    stop_before_the_record(monkeypatch, lambda: warehouse.run(users(spark), orders(spark), RUN_1))
    warehouse.ingest(["sales"], RUN_1)
    warehouse = WideWarehouse(spark, str(tmp_path))
    warehouse.run(users(spark), orders(spark), RUN_2)
    assert rows(warehouse.fact_sales.read().groupBy("is_effective").count()) == [(True, 3)]
    assert warehouse.watermark("sales") == PLACED


def test_a_repeated_batch_does_not_take_later_folders_into_account(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), [])
    warehouse.land("users", users(spark), RUN_1)
    warehouse.land("users", users(spark, [(4, "d", 5, "x", LATER, None)]), RUN_2)
    assert warehouse.watermark("users", RUN_2) == PLACED and warehouse.watermark("users") == LATER
    assert warehouse.watermark("users", RUN_1).year == 1000


LATE = (4, "anna", 40, "x", PLACED, None)  # committed after the first read, with the time of its newest row
OLD = (5, "bert", 41, "y", PLACED - timedelta(hours=2), None)
OLDER = (6, "cleo", 42, "z", PLACED - timedelta(days=3), None)


def landed_ids(spark, tmp_path, entity, key="id"):
    files = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/landing/{entity}")
    return sorted(r[0] for r in files.select(key).collect())


def test_rows_that_are_committed_late_land_once(spark, tmp_path):
    warehouse = StarWarehouse(spark, str(tmp_path), overlap=timedelta(days=1))
    warehouse.extract(users(spark), orders(spark), RUN_1)
    everyone = users(spark).unionByName(users(spark, [LATE, OLD, OLDER]))
    warehouse.extract(everyone, orders(spark), RUN_2)
    assert landed_ids(spark, tmp_path, "users") == [1, 2, 3, 4, 5]  # one is older than the overlap
    assert landed_ids(spark, tmp_path, "orders") == [1, 2, 3]
    warehouse.extract(everyone, orders(spark), RUN_3)
    assert landed_ids(spark, tmp_path, "users") == [1, 2, 3, 4, 5] and warehouse.watermark("users") == PLACED
    # A row that changes inside the overlap is another row.
    warehouse.extract(everyone.where("id <> 4").unionByName(users(spark, [(*LATE[:5], LATER)])), orders(spark), RUN_4)
    assert landed_ids(spark, tmp_path, "users") == [1, 2, 3, 4, 4, 5] and warehouse.watermark("users") == LATER


def test_a_batch_of_late_rows_leaves_the_watermark(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), [], overlap=timedelta(days=1))
    warehouse.extract_table("users", users(spark), RUN_1)
    assert warehouse.extract_table("users", users(spark, [OLD]), RUN_2)["rows"] == 1
    assert warehouse.watermark("users") == PLACED


def test_without_overlap_a_read_is_strictly_after_the_watermark(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), [])
    warehouse.extract_table("users", users(spark), RUN_1)
    assert warehouse.extract_table("users", users(spark, [LATE]), RUN_2) is None


def test_late_orders_land_once_in_the_wide_model(spark, tmp_path):
    warehouse = WideWarehouse(spark, str(tmp_path), overlap=timedelta(days=1))
    warehouse.run(users(spark), orders(spark), RUN_1)
    moved = users(spark, [(1, "francisco", 35, "new road 1", PLACED, LATER)]).unionByName(users(spark).where("id > 1"))
    late = orders(spark).unionByName(orders(spark, [(4, 2, 9, "processing", PLACED, None)]))
    for at in (RUN_2, RUN_3):  # a changed user alone brings no row
        warehouse.run(moved, late, at)
        assert sorted(r.order_id for r in warehouse.fact_sales.read().collect()) == [1, 2, 3, 4]


def versions_of(spark):
    """Users and orders of three loads; user 1 and order 1 change in each, order 4 enters with the second, 5 with the third."""
    change = lambda n: timedelta(hours=n)
    people = [users(spark)] + [users(spark, [(1, "francisco", 34 + n, f"road {n}", PLACED, PLACED + change(n))]) for n in (1, 2)]
    batches = [
        orders(spark),
        orders(spark, [(1, 1, 30, "shipped", PLACED, LATER), (4, 1, 7, "processing", LATER, None)]),
        orders(spark, [(1, 1, 30, "pending", PLACED, LATER + change(1)), (5, 1, 8, "processing", LATER, None), (4, 1, 7, "shipped", LATER, LATER + change(2))]),
    ]
    return list(zip((RUN_1, RUN_2, RUN_3), people, batches))


def gold(warehouse):
    return [rows(t.read()) for t in (warehouse.dim_user, warehouse.dim_orderstatus, warehouse.fact_orders)]


@pytest.mark.parametrize("at_once", [8, 2, 1])
def test_a_catch_up_equals_single_runs(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr("tidemark.plans.cdc.FEEDS_AT_ONCE", at_once)
    single, behind = ChangeWarehouse(spark, f"{tmp_path}/a"), ChangeWarehouse(spark, f"{tmp_path}/b")
    for at, people, batch in versions_of(spark):
        for warehouse in (single, behind):
            warehouse.upsert(users_to_silver(people), orders_to_silver(batch), at)
        single.refresh(at)
    behind.refresh(RUN_4)
    assert gold(behind) == gold(single)
    assert len(gold(single)[0]) == 5 and len(gold(single)[2]) == 5
    assert behind.dim_user.version == behind.fact_orders.version == -(-3 // at_once)
    behind.refresh(RUN_4)
    assert behind.fact_orders.version == -(-3 // at_once)


def test_facts_may_lag_behind_their_dimensions(spark, tmp_path, monkeypatch):
    """A refresh that stopped between dimensions and facts gives the facts of the load they belong to."""
    single, broken = ChangeWarehouse(spark, f"{tmp_path}/a"), ChangeWarehouse(spark, f"{tmp_path}/b")
    for n, (at, people, batch) in enumerate(versions_of(spark)):
        for warehouse in (single, broken):
            warehouse.upsert(users_to_silver(people), orders_to_silver(batch), at)
        single.refresh()
        if n < 2:
            with monkeypatch.context() as patched:
                patched.setattr(type(broken.fact_orders), "append", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
                with pytest.raises(RuntimeError, match="stopped"):
                    broken.refresh()
    broken.refresh()
    assert gold(broken) == gold(single)


def second(spark):
    return users(spark, [(7, "gerd", 50, "north", LATER, None)]).withColumnRenamed("address", "segment")


def test_rows_are_read_by_the_version_they_were_written_with(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), [])
    warehouse.publish_contracts("users")
    warehouse.publish_contract("users", USERS_SECOND_VERSION, "2_0")
    warehouse.land("users", users(spark), RUN_1)
    warehouse.land("users", second(spark), RUN_2, "2_0")
    assert warehouse.watermark("users") == LATER
    warehouse.ingest(["users"], RUN_2)
    found = deduplicated_extract(read_bronze(spark, f"{tmp_path}/bronze/users"), warehouse.versions("users"))
    assert rows(found.select("id", "address", "segment", "schema_version"))[-1] == (7, None, "north", "2_0")
    assert found.where("segment is null and address is not null").count() == 3


def test_an_unknown_version_fails_by_name(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), [])
    warehouse.publish_contracts("users")
    warehouse.publish_contract("users", USERS_SECOND_VERSION, "2_0")
    landing.write_landing(users(spark), f"{tmp_path}/landing", "users", RUN_1, version="3_1")
    warehouse.ingest(["users"], RUN_1)
    with pytest.raises(Exception, match="unknown schema version 3_1"):
        deduplicated_extract(read_bronze(spark, f"{tmp_path}/bronze/users"), warehouse.versions("users")).collect()


def test_a_field_is_required_of_the_versions_that_require_it(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), [])
    warehouse.publish_contracts("users")
    warehouse.publish_contract("users", USERS_SECOND_VERSION, "2_0")
    landing.write_landing(second(spark).withColumn("segment", F.lit(None).cast("string")), f"{tmp_path}/landing", "users", RUN_1, version="2_0")
    warehouse.ingest(["users"], RUN_1)
    with pytest.raises(Exception, match="segment"):
        deduplicated_extract(read_bronze(spark, f"{tmp_path}/bronze/users"), warehouse.versions("users")).collect()


def test_versions_are_widened():
    one = [RegistryField("id", "integer", False), RegistryField("code", "integer", False), RegistryField("old", "string", False)]
    two = [RegistryField("id", "integer", False), RegistryField("code", "string", False), RegistryField("new", "integer", False)]
    found = [(f.name, f.type, f.nullable) for f in widened({"1_0": one, "2_0": two})]
    assert found == [("id", "integer", False), ("code", "string", False), ("old", "string", True), ("new", "integer", True)]
    with pytest.raises(TypeError, match="id is integer"):
        widened({"1_0": one, "2_0": [RegistryField("id", "datetime", False)]})
