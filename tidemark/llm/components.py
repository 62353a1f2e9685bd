"""Connected components of an edge table, by stars that shrink towards the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.skew import join_aggregate


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is named by its smallest node.

    Each round links the larger neighbours of every node to the smallest one around it, then does the same among
    smaller neighbours, until no edge changes. Minima combine before their shuffle, and a node with very many
    neighbours meets its minimum in a join that Spark can split. Each round is a table in the shared ``folder``.
    """
    spark = edges.sparkSession
    edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().write.parquet(f"{folder}/0")
    step, before = 0, None
    while True:
        current = spark.read.parquet(f"{folder}/{step}")  # a > b
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = join_aggregate(both, lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.union(lowest.filter("low < a").select("a", F.col("low").alias("b"))).distinct()
        large.write.parquet(f"{folder}/{step}-large")
        large = spark.read.parquet(f"{folder}/{step}-large")
        smallest = large.groupBy("a").agg(F.min("b").alias("low"))
        small = join_aggregate(large, smallest, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        step += 1
        small.union(smallest.select("a", F.col("low").alias("b"))).distinct().write.parquet(f"{folder}/{step}")
        after = spark.read.parquet(f"{folder}/{step}").agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    roots = spark.read.parquet(f"{folder}/{step}")  # every node but the smallest one points at it
    return roots.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
