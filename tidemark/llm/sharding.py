"""Jump consistent hashing: a stable key and the number of shards decide the shard, without a ring table.

Law: ``key``. A shard that is appended takes rows only into itself. All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the published generator: a 64-bit linear congruence whose upper 31 bits are drawn.
MULTIPLIER = 2862933555777941757
MODULUS = 18446744073709551616
DRAWN = 2147483648
DROPPED = 8589934592


def _checked(shards: int) -> int:
    if shards < 1:
        raise ValueError("there must be one shard at least")
    return shards


def jump_shards(key: str, shards: int) -> Column:
    """``shard`` among ``shards`` and ``grown`` among one more, from one walk over the jumps of the key.

    The walk visits rising shard numbers; the last one below a count is the shard for that count. Products
    stay below 10^38, so decimals hold them exactly. ``key`` is a bigint column; a missing key counts as 0,
    a negative one as its unsigned 64-bit value.
    """
    _checked(shards)
    # A jump moves up by one shard at least, so that shards + 1 steps always end the walk.
    step = f"""
        transform(
            array(cast((walk.state * {MULTIPLIER}BD + 1BD) % {MODULUS}BD as decimal(20, 0))),
            state -> named_struct(
                'shard', if(walk.next < {shards}, walk.next, walk.shard),
                'grown', walk.next,
                'next', cast(floor((walk.next + 1) * ({DRAWN}D / (cast(state div {DROPPED}BD as double) + 1D))) as bigint),
                'state', state
            )
        )[0]"""
    start = f"cast(if({key} < 0, {MODULUS}BD, 0BD) + cast(coalesce({key}, 0L) as decimal(20, 0)) as decimal(20, 0))"
    return F.expr(
        f"""aggregate(
            sequence(0, {shards}),
            named_struct('shard', 0L, 'grown', 0L, 'next', 0L, 'state', coalesce({start}, 0BD)),
            (walk, i) -> if(walk.next > {shards}, walk, {step}),
            walk -> named_struct('shard', cast(walk.shard as int), 'grown', cast(walk.grown as int))
        )"""
    )


def assign(df: DataFrame, key: str, shards: int, shard: str = "shard") -> DataFrame:
    """``df`` with the shard of each row in a new column; a column of that name is replaced."""
    return df.withColumn(shard, jump_shards(f"cast(`{key}` as bigint)", shards)["shard"])


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """One folder of Parquet files per shard. Rows are not shuffled: each task adds its files to the folders."""
    assign(df, key, shards).write.partitionBy("shard").mode("overwrite").parquet(path)


def placed(documents: DataFrame, shards: int = 40, slot_groups: int = 256) -> DataFrame:
    """Shard and place of every document.

    ``slot`` numbers the rows of a shard from 0 without gaps. A shard is numbered in ``slot_groups`` hashed
    groups side by side; the start of each group comes from counts (shards x slot_groups rows, so that their
    broadcast is bounded). Missing texts have no bytes; rows with the same id and text are alike, so that any
    order among them gives the same result. An empty table gives no row; other columns are not looked at.
    """
    walk = jump_shards("doc_id", shards)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    ).withColumn("walk", walk)
    rows = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("walk.shard").alias("shard"),
        F.col("walk.grown").alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slot_groups)).alias("slot_group"),
    )
    before = Window.partitionBy("shard").orderBy("slot_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("shard", "slot_group")
        .agg(F.count("*").alias("n"))
        .select("shard", "slot_group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("shard", "slot_group").orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("place", F.row_number().over(inside))
        .join(F.broadcast(starts), ["shard", "slot_group"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("start") + F.col("place") - 1).alias("slot"),
            "grown_shard",
        )
    )
