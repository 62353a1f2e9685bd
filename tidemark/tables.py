"""Versioned parquet tables for gold and silver: an effective slice in hash partitions, a history that grows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import children, folder_bytes, path_exists, write_text
from tidemark.session import plan_bytes

COMMIT = (
    "version int, batch_id string, folder string, partitions int, touched array<int>, parts array<int>, "
    "current_bytes bigint, has_history boolean, last_key bigint"
)

# Of compressed files, until there are MOST_PARTS of them. One task writes a partition: rows in memory are about ten times
# as large, and a partition may be outgrown four times over.
PART_BYTES = 8 * 1024 * 1024
MOST_PARTS = 4096


class KeyViolation(ValueError):
    """Rows of a batch break a key of their table; none of the batch was committed."""


class SnapshotTable:
    """A table of parquet folders, one per commit, and a small commit log written after the data.

    The effective slice lies in partitions by a hash of the key. A merge reads the partitions that its batch touches,
    and its commit holds these alone; the others stay where earlier commits wrote them. A commit never changes files of
    an earlier one: readers keep their version, and a failed job leaves a folder that no commit names. A batch id is
    committed once. One writer at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        surrogate: str | None = None,
        partitions: int | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.surrogate = key, surrogate
        self._wanted = partitions
        self._commits: list[Row] | None = None

    @property
    def commits(self) -> list[Row]:
        """Commit log, oldest first: one row per batch."""
        if self._commits is None:
            log = f"{self.path}/commits"
            found = []
            if path_exists(self.spark, log):
                found = self.spark.read.schema(COMMIT).json(log).collect()
            self._commits = sorted(found, key=lambda c: c.version)
        return self._commits

    @property
    def version(self) -> int:
        return self.commits[-1].version if self.commits else 0

    @property
    def partitions(self) -> int:
        """Partitions of the effective slice, 0 before its first commit."""
        return max((c.partitions for c in self.commits), default=0)

    def has(self, batch_id: str) -> bool:
        return any(c.batch_id == batch_id for c in self.commits)

    def next_key(self) -> int:
        return max((c.last_key or 0 for c in self.commits), default=0) + 1

    def _empty(self) -> DataFrame:
        # The filter lets the optimizer drop the frame, and joins with it; else Python workers deliver no rows.
        return self.spark.createDataFrame([], self.schema).where(F.lit(False))

    def _live(self, version: int | None = None) -> dict[int, Row]:
        """For each partition with rows the commit that wrote it last, as of a version."""
        live: dict[int, Row] = {}
        for commit in self.commits:
            if version is None or commit.version <= version:
                live = {p: c for p, c in live.items() if c.partitions == commit.partitions or not commit.partitions}
                for part in commit.touched:
                    live.pop(part, None)
                live |= {part: commit for part in commit.parts}
        return live

    def current(self, version: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """The effective rows as of a version, by default the latest; of some partitions only, if given."""
        live = self._live(version)
        asked = set(live if parts is None else parts)
        chosen = {p: c for p, c in live.items() if p in asked}
        paths = []
        for folder, own in {c.folder: c.parts for c in chosen.values()}.items():
            mine = [p for p, c in chosen.items() if c.folder == folder]
            whole = len(mine) == len(own)
            paths += [f"{folder}/slice=current"] if whole else [f"{folder}/slice=current/part={p}" for p in mine]
        return self._files(paths)

    def history(self, after: int = 0) -> DataFrame:
        """Closed versions, or every row of a table that is only appended to; those of commits after a version."""
        return self._files([f"{c.folder}/slice=history" for c in self.commits if c.has_history and c.version > after])

    def _files(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self._empty()
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*paths)

    def read(self) -> DataFrame:
        return self.current().unionByName(self.history())

    def part_of(self, partitions: int) -> Column:
        """The partition of a row; the type of the key decides its hash, so that it is the table's own."""
        return F.pmod(F.xxhash64(F.col(self.key).cast(self.schema[self.key].dataType)), F.lit(partitions)).cast("int")

    def _fit(self, batch: DataFrame) -> int:
        """Partitions for the table with a batch: as chosen, or by the size of files, doubled only when it is outgrown
        four times over. A table that gets more partitions is written anew, once."""
        if self._wanted:
            return self._wanted
        stored = sum(c.current_bytes // len(c.parts) for c in self._live().values())
        wanted = min(MOST_PARTS, 1 << max(0, (-(-(plan_bytes(batch) + stored) // PART_BYTES) - 1).bit_length()))
        return wanted if wanted > 4 * self.partitions else self.partitions

    def merge(
        self,
        batch: DataFrame,
        batch_id: str,
        build: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
        effective_only: bool = False,
    ) -> bool:
        """Merges a batch into the effective slice: ``build(stored)`` gives the kept and the new rows.

        ``stored`` are the effective rows of the partitions in which the batch has keys, and only these are replaced.
        Rows that are no longer effective join the history; with ``effective_only`` the table has no such mark.
        A key with two new effective rows fails the batch with their number. The rows of a key are written by one task,
        which meets them side by side, so the proof takes no shuffle of its own.
        """
        if self.has(batch_id):
            return False
        partitions = self._fit(batch)
        if partitions == 1 or partitions != self.partitions:
            touched, stored = list(range(partitions)), self.current()
        else:
            # At most one row per partition.
            keys = batch.select(self.part_of(partitions).alias("part")).distinct()
            touched = sorted(r.part for r in keys.collect())
            stored = self.current(parts=touched)
        kept, new = build(stored)
        part, mark = self.part_of(partitions), F.lit("current")
        if not effective_only:
            mark = F.when(F.col("is_effective"), "current").otherwise("history")
        # Stored rows are not moved again: a scan task holds few partitions. New rows are brought together by partition.
        sent = new.select(*self.schema.names).withColumn("part", part).repartition(F.col("part"))
        same = ["part", self.key] if effective_only else ["part", self.key, "is_effective"]
        sent = sent.withColumn("_copy", F.row_number().over(Window.partitionBy(*same).orderBy(self.key)))
        stays = kept.select(*self.schema.names).withColumns({"part": part, "_copy": F.lit(1)})
        rows = (stays.unionByName(sent) if self.version else sent).withColumn("slice", mark)
        broken = {f"a repeated {self.key}": (F.col("_copy") > 1) & (F.col("slice") == "current")}
        return self._commit(rows, ["slice", "part"], batch_id, partitions, touched, broken)

    def append(self, rows: DataFrame, batch_id: str, broken: Mapping[str, Column] | None = None) -> bool:
        """All rows join the history. ``broken`` names conditions that no row may meet; columns beside the table's serve
        them alone. Rows that meet one are counted as they are written, and fail the batch before its commit."""
        if self.has(batch_id):
            return False
        return self._commit(rows.withColumn("slice", F.lit("history")), ["slice"], batch_id, 0, [], broken or {})

    def _commit(
        self, rows: DataFrame, by: list[str], batch_id: str, partitions: int, touched: list[int], broken: Mapping[str, Column]
    ) -> bool:
        version, token = self.version + 1, uuid.uuid4().hex
        folder = f"{self.path}/data/{version:06d}-{token}"
        metrics = [F.count_if(rule).alias(f"broken_{i}") for i, rule in enumerate(broken.values())]
        if self.surrogate:
            metrics.append(F.max(self.surrogate).cast("bigint").alias("last_key"))
        seen = Observation(token)
        if metrics:
            rows = rows.observe(seen, *metrics)
        rows.select(*self.schema.names, *by).write.partitionBy(*by).parquet(folder)
        found = seen.get if metrics else {}
        counts = {name: found.get(f"broken_{i}") or 0 for i, name in enumerate(broken)}
        if any(counts.values()):
            told = ", ".join(f"{count} rows with {name}" for name, count in counts.items() if count)
            raise KeyViolation(f"nothing of batch {batch_id} was committed to {self.path}: {told}")
        last_key = found.get("last_key")
        parts = sorted(int(name.split("=")[1]) for name in children(self.spark, f"{folder}/slice=current") if name.startswith("part="))
        commit = {
            "version": version, "batch_id": batch_id, "folder": folder, "partitions": partitions, "touched": touched, "parts": parts,
            "current_bytes": folder_bytes(self.spark, f"{folder}/slice=current") if parts else 0,
            "has_history": path_exists(self.spark, f"{folder}/slice=history"), "last_key": last_key,
        }
        write_text(self.spark, f"{self.path}/commits/{version:06d}.json", json.dumps(commit))
        self.commits.append(Row(**commit))
        return True


def create_or_replace(df: DataFrame, path: str) -> DataFrame:
    """A stage table replaced as a whole: written once, then read from its files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
