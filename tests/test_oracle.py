"""Every registered query against its SQL oracle on the driver's tables."""

import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{FOLDER}/{name}.parquet')")
    yield connection
    connection.close()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


SAME_TYPE = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def test_every_query_of_the_library_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    relation = duck.sql(oracle_sql()[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: SAME_TYPE[f.dataType.simpleString()] for f in result.schema.fields} == types
    ours, expected = _rows(result.columns, result.collect()), _rows(relation.columns, relation.fetchall())
    assert len(ours) == len(expected)
    assert ours == expected
    assert ours, "a query over whole tables should return rows"
