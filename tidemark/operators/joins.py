"""Lookup join that survives a hot key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import plan_bytes, shuffle_width

def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


@dataclass(frozen=True)
class Skew:
    """Join keys that hold more rows than two fair shares of a shuffle partition."""

    keys: list
    nulls: bool

    def __bool__(self) -> bool:
        return self.nulls or bool(self.keys)


def find_skew(df: DataFrame, key: str) -> Skew:
    """All hot keys of a join column, and whether NULL is one.

    Keys are counted exactly, and counts combine before their shuffle. As a hot key holds more than two fair
    shares of a partition, there are fewer of them than half the partitions: these many of the largest counts come to
    the driver, and all rows are counted in the same pass.
    """
    width, seen = shuffle_width(df.sparkSession), Observation()
    counts = df.select(key).observe(seen, F.count(F.lit(1)).alias("rows")).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    largest = counts.orderBy(F.desc("rows")).limit(max(1, width // 2)).collect()
    hot = [r[0] for r in largest if r["rows"] * width > 2 * seen.get["rows"]]
    return Skew([k for k in hot if k is not None], None in hot)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    how: str = "left",
    limit_bytes: int | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join many rows to a table looked up by key, where some keys may hold a large part of the rows.

    A lookup side below the broadcast limit is left to Spark, which then shuffles neither side; which way is taken
    changes the plan and never the rows. Beyond the limit the hot keys are found first. Rows of other keys meet the
    lookup on the plain key. Rows of hot keys, and rows without a
    key if these are many, are spread over all shuffle partitions, and the lookup rows of the hot keys are repeated
    to meet them. ``counted`` may be a frame with the same keys that is cheaper to count than ``facts``. The table of hot keys that is broadcast has fewer rows than half the shuffle partitions.
    """
    limit = broadcast_limit(lookup) if limit_bytes is None else limit_bytes
    same_key = F.col(fact_key) == F.col(lookup_key)
    skew = find_skew(facts if counted is None else counted, fact_key) if plan_bytes(lookup) > limit else None
    if not skew:
        return facts.join(lookup, same_key, how)

    spark, width = facts.sparkSession, shuffle_width(facts.sparkSession)
    kind = T.StructType([T.StructField("_hot_key", facts.schema[fact_key].dataType)])
    hot_keys = F.broadcast(spark.createDataFrame([(k,) for k in skew.keys], kind))
    is_hot = F.col(fact_key) == F.col("_hot_key")
    cold = facts.join(hot_keys, is_hot, "left_anti")
    hot = facts.join(hot_keys, is_hot, "left_semi")
    if skew.nulls:
        cold, hot = cold.where(F.col(fact_key).isNotNull()), hot.unionByName(facts.where(F.col(fact_key).isNull()))
    spread = F.pmod(F.xxhash64(*facts.columns), F.lit(width)).cast("int")
    repeated = lookup.join(hot_keys, F.col(lookup_key) == F.col("_hot_key"), "left_semi")
    repeated = repeated.withColumn("_lookup_salt", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    met = hot.withColumn("_salt", spread).join(repeated, same_key & (F.col("_salt") == F.col("_lookup_salt")), how)
    return cold.join(lookup, same_key, how).unionByName(met.drop("_salt", "_lookup_salt"))
