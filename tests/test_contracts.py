"""Schema contracts, record checks, keys."""

import pytest
from pyspark.sql import functions as F

from seed import PLACED, orders, rows, users
from tidemark.operators import constraints, contracts
from tidemark.sources.contracts import source_schema

USER = '{"id": 10, "address": "DonOfDen", "age": 30, "created_at": "2020-12-07 20:06:00", "name": "paco"}'


def check(spark, schema, *texts):
    records = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, record string")
    found = contracts.validate_records(records, "record", schema).orderBy("id").collect()
    return [(r.valid, list(r.breaches)) for r in found]


def test_valid_record(spark):
    records = spark.createDataFrame([(USER,)], "record string")
    row = contracts.validate_records(records, "record", contracts.USERS_RECORD).first()
    assert row.valid and row.message == "Given JSON data is Valid" and row.breaches == []


def test_bounds_types_and_missing_keys(spark):
    def user(age):
        return USER.replace('"age": 30', f'"age": {age}')

    results = check(
        spark,
        contracts.USERS_RECORD,
        user(1), user(110), user(0), user(111), user('"30"'), user("true"), user("null"), user("1.5"),
        '{"id": 1}', "[1]", "no json", None, USER.replace('"paco"', "7"),
    )
    assert [valid for valid, _ in results] == [True, True, False, False, False, False, False, True] + [False] * 5
    assert results[2][1] == ["age: below 1"] and results[3][1] == ["age: above 110"]
    assert results[4][1] == results[5][1] == results[6][1] == ["age: not a number"]
    assert results[8][1] == ["address: missing", "age: missing", "created_at: missing", "name: missing"]
    assert results[9][1] == results[10][1] == results[11][1] == ["not an object"]
    assert results[12][1] == ["name: not a string"]


def test_order_records(spark):
    order = '{"id": 1, "id_user": 2, "created_at": "x", "spent": %s, "status": "processing"}'
    results = check(spark, contracts.ORDERS_RECORD, order % 1, order % 0, order % -5)
    assert results == [(True, []), (False, ["spent: below 1"]), (False, ["spent: below 1"])]


def test_enforce_accepts_the_seed_and_rejects_nulls_and_columns(spark):
    contract = source_schema("users")
    assert contracts.enforce(users(spark), contract).count() == 3
    unnamed = users(spark, [(1, None, 34, "a", PLACED, None)])
    with pytest.raises(Exception, match="NULL in NOT NULL column name"):
        contracts.enforce(unnamed, contract).collect()
    with pytest.raises(contracts.ContractError, match="missing column age"):
        contracts.enforce(users(spark).drop("age"), contract)
    with pytest.raises(contracts.ContractError, match="column age is string"):
        contracts.enforce(users(spark).withColumn("age", F.col("age").cast("string")), contract)
    with pytest.raises(contracts.ContractError, match="unexpected column extra"):
        contracts.enforce(users(spark).withColumn("extra", F.lit(1)), contract)
    assert contracts.enforce(users(spark).withColumn("id", F.col("id").cast("bigint")), contract).count() == 3


def test_null_breaches(spark):
    broken = users(spark, [(1, None, None, "a", PLACED, None), (2, None, 3, "a", PLACED, None)])
    assert rows(contracts.null_breaches(broken, source_schema("users"))) == [("age", 1), ("name", 2)]
    assert rows(contracts.null_breaches(users(spark), source_schema("users"))) == []


def test_duplicate_keys(spark):
    delivered = orders(spark).unionByName(orders(spark).where("id = 2"))
    assert rows(constraints.duplicate_keys(delivered, "id")) == [(2, 2)]
    nulls = spark.createDataFrame([(None,), (1,)], "id int")
    assert rows(constraints.duplicate_keys(nulls, "id")) == [(None, 1)]


def test_orphans_ignore_a_null_key(spark):
    children = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, id_user int")
    assert rows(constraints.orphans(children, "id_user", users(spark), "id")) == [(2, 9)]
