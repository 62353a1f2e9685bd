"""Deduplication, surrogate keys and the lookup join, with hot keys."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seed import LATER, PLACED, orders, rows
from tidemark.functions.hashing import record_hash, row_hash
from tidemark.operators import dedup, joins, keys


def test_row_hash_tells_fields_apart(spark):
    values = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("", "c"), ("a\\|b", "c"), ("a\\", "b|c")]
    df = spark.createDataFrame(values, "x string, y string")
    for digest in (row_hash(["x", "y"]), record_hash(["x", "y"])):
        assert df.select(digest).distinct().count() == len(values)


def test_first_per_hash_keeps_the_first_arrival(spark):
    df = spark.createDataFrame(
        [("h", LATER, "f1", 1), ("h", PLACED, "f2", 2), ("h", PLACED, "f1", 9), ("g", PLACED, "f1", 1)],
        "md5 string, created_at timestamp_ntz, source string, metadata_row_number int",
    )
    assert {(r.md5, r.source, r.metadata_row_number) for r in dedup.first_per_hash(df).collect()} == {
        ("h", "f1", 9),
        ("g", "f1", 1),
    }


def test_first_per_hash_beside_a_variant(spark):
    df = spark.sql(
        "select parse_json('{\"a\": 1}') raw, 'h' md5, timestamp_ntz'2020-01-01' created_at, 's' source, id metadata_row_number from range(100)"
    )
    assert dedup.first_per_hash(df).select("metadata_row_number").collect()[0][0] == 0


def test_newest_per_key(spark):
    batch = orders(
        spark,
        [(1, 1, 1, "a", PLACED, None), (1, 1, 1, "b", PLACED, LATER), (2, 1, 1, "x", PLACED, None), (2, 1, 1, "y", PLACED, None)],
    )
    found = {r.id: r.status for r in dedup.newest_per_key(batch, "id", "updated_at", "created_at").collect()}
    assert found == {1: "b", 2: "y"}


def test_copies_are_cut_before_the_shuffle(spark):
    plan = dedup.first_per_key(orders(spark), ["id"], ["status"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=st.sets(st.integers(-(2**40), 2**40), max_size=200), first=st.integers(1, 10**9), slices=st.integers(1, 7))
def test_surrogate_keys_are_dense_and_follow_the_data(spark, ids, first, slices):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(slices)
    keyed = keys.with_surrogate_keys(df, ["id"], first)
    found = {r.id: r.sk for r in keyed.collect()}
    assert sorted(found.values()) == list(range(first, first + len(ids)))
    again = keys.with_surrogate_keys(df.repartition(3), ["id"], first)
    assert {r.id: r.sk for r in again.collect()} == found


def test_next_key(spark):
    assert keys.next_key(None) == 1
    assert keys.next_key(spark.createDataFrame([], "sk bigint")) == 1
    assert keys.next_key(spark.createDataFrame([(4,), (2,)], "sk bigint")) == 5


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without a key."""
    facts = spark.range(6000).select(
        "id", F.expr("case when id % 3 = 0 then 7 when id % 3 = 1 then null else id end").alias("k")
    )
    lookup = spark.range(0, 6000, 2).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))
    return facts, lookup.unionByName(spark.createDataFrame([(7, 70)], "key bigint, value bigint"))


def test_skew_is_found(spark, skewed):
    skew = joins.find_skew(skewed[0], "k")
    assert skew.keys == [7] and skew.nulls
    assert not joins.find_skew(spark.range(1000), "id")


def test_hundreds_of_hot_keys_are_all_spread(spark):
    width = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        facts = spark.range(60_000).select("id", F.expr("if(id % 3 = 0, id, -1 - id % 300)").alias("k"))
        lookup = spark.range(-400, 60_000).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))
        skew = joins.find_skew(facts, "k")
        assert sorted(skew.keys) == sorted(-1 - i for i in range(300) if i % 3) and not skew.nulls
        joined = joins.lookup_join(facts, lookup, "k", "key", limit_bytes=0)
        assert rows(joined) == rows(facts.join(lookup, F.col("k") == F.col("key"), "left"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, how):
    facts, lookup = skewed
    plain = facts.join(lookup, F.col("k") == F.col("key"), how)
    salted = joins.lookup_join(facts, lookup, "k", "key", how, limit_bytes=0)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salted_join_spreads_the_hot_key(spark, skewed):
    facts, lookup = skewed
    # Without broadcast and without merging small partitions, as with large tables.
    large = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in large}
    for name, value in large.items():
        spark.conf.set(name, value)
    try:
        joined = joins.lookup_join(facts, lookup, "k", "key")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 6000 and max(sizes) < 2000


def test_small_lookup_is_left_to_spark(skewed):
    facts, lookup = skewed
    plan = joins.lookup_join(facts, lookup.limit(5), "k", "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan


def test_many_versions_of_a_hot_key(spark):
    facts = spark.range(1000).select("id", F.lit(1).cast("bigint").alias("k"))
    lookup = spark.createDataFrame([(1, v) for v in range(5)] + [(2, 0)], "key bigint, v int")
    assert joins.lookup_join(facts, lookup, "k", "key", limit_bytes=0).count() == 5000
