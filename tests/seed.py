"""Seed rows of the operational source: three users and three orders, one user without an order."""

from datetime import datetime

from tidemark.functions.schemas import struct

PLACED = datetime(2021, 12, 8, 20, 2, 42)
LATER = datetime(2021, 12, 9, 8, 0, 0)
RUN_1, RUN_2, RUN_3 = "2021-12-10 00:00:00", "2021-12-11 00:00:00", "2021-12-12 00:00:00"

USERS = struct(
    {"id": "int", "name": "string", "age": "int", "address": "string", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
)
ORDERS = struct(
    {"id": "int", "id_user": "int", "spent": "int", "status": "string", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
)


def users(spark, rows=None):
    seed = [
        (1, "francisco", 34, "chalk avenue 23", PLACED, None),
        (2, "samuel", 86, "crown road 101", PLACED, None),
        (3, "john", 20, "salvador square 10", PLACED, None),
    ]
    return spark.createDataFrame(seed if rows is None else rows, USERS)


def orders(spark, rows=None):
    seed = [
        (1, 1, 30, "processing", PLACED, None),
        (2, 1, 20, "processing", PLACED, None),
        (3, 3, 100, "processing", PLACED, None),
    ]
    return spark.createDataFrame(seed if rows is None else rows, ORDERS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
