"""Stages that both warehouse designs share: extract to landing, landing to bronze, bronze to typed extract."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import children, path_exists, read_text, write_text
from tidemark.functions.clock import EXTRACT_FLOOR, as_datetime
from tidemark.functions.schemas import struct
from tidemark.operators.audit import FAILURES, RULES, Rule, require_passed, rule_table, run_audit
from tidemark.operators.contracts import enforce
from tidemark.sources.contracts import SCHEMA_VERSION, SOURCE_TIMES, landed_form, source_schema, stored_schema
from tidemark.sources.incremental import incremental_rows, not_landed
from tidemark.sources.landing import landed_batch, landed_since, read_landing, write_landing
from tidemark.sources.registry import (
    RegistryField,
    arriving_columns,
    first_arrivals,
    parse_schema,
    publish_schema,
    read_registry,
    widened,
)
from tidemark.streaming.bronze import start_bronze
from tidemark.streaming.delta import consume
from tidemark.tables import SnapshotTable, create_or_replace

RECORD = "%Y%m%dT%H%M%S.json"  # name of a batch's record


class Warehouse:
    """Folders of one warehouse and the stages that fill them.

    ``overlap`` makes reads of the source lossless where rows may be committed with a time that an earlier read has passed:
    each read starts so much before the watermark, and rows that have landed since then are taken out by their hash. It
    should be longer than the longest transaction of the source. Off by default, for sources in strict order.
    """

    def __init__(
        self, spark: SparkSession, root: str, rules: Sequence[Rule], stop_on_failure: bool = True, overlap: timedelta | None = None
    ):
        self.spark, self.root, self.rules = spark, root.rstrip("/"), list(rules)
        self.stop_on_failure, self.overlap = stop_on_failure, overlap
        self._sources: dict[tuple[str, str], T.StructType] = {}
        self._registry: dict[str, dict[str, str]] | None = None

    def gold(self, name: str, schema: T.StructType, key: str, surrogate: str | None = None) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/gold/{name}", schema, key, surrogate)

    def publish_contracts(self, *entities: str) -> None:
        for entity in entities:
            self.publish_contract(entity, source_schema(entity))

    def publish_contract(self, entity: str, source: T.StructType, version: str = SCHEMA_VERSION) -> None:
        """Declares what a version of an entity delivers; its landed form becomes a document of the registry."""
        self._sources[entity, version] = source
        publish_schema(self.spark, f"{self.root}/landing", entity, landed_form(source), version)
        self._registry = None

    def versions(self, entity: str) -> dict[str, list[RegistryField]]:
        """The fields of every published version of an entity."""
        if self._registry is None:
            self._registry = read_registry(self.spark, f"{self.root}/landing")
        return {version: parse_schema(text) for version, text in self._registry[entity].items()}

    def watermark(self, entity: str, before: datetime | str | None = None) -> datetime:
        """The newest source time that was landed, kept per entity: one small record per batch.

        With ``before``, by batches taken earlier than that: a repeated batch selects what it selected at first. The landed
        folder is the commit of a batch, so records that a stopped run did not write are written first. A record holds
        the newest time up to its batch, so that the last one tells.
        """
        end = datetime.max if before is None else as_datetime(before)
        log = f"{self.root}/control/{entity}"
        times = [datetime.strptime(name, RECORD) for name in children(self.spark, log) if not name.startswith(("_", "."))]
        last = max((t for t in times if t < end), default=None)
        mark = EXTRACT_FLOOR
        if last:
            mark = as_datetime(json.loads(read_text(self.spark, f"{log}/{last:{RECORD}}"))["watermark"])
        for at, path in landed_since(self.spark, f"{self.root}/landing", entity, last):
            if at < end:
                mark = self._record(entity, at, landed_batch(self.spark, path, *SOURCE_TIMES[entity]), mark)
        return mark

    def _record(self, entity: str, at: datetime, landed: dict, before: datetime) -> datetime:
        """Writes the record of a batch; a batch of late rows alone leaves the watermark where it was."""
        mark = max(before, as_datetime(landed["watermark"])) if landed["watermark"] else before
        text = json.dumps({"watermark": mark.isoformat(sep=" "), "rows": landed["rows"], "path": landed["path"]})
        write_text(self.spark, f"{self.root}/control/{entity}/{at:{RECORD}}", text)
        return mark

    def unread(self, entity: str, read: Callable[[datetime], DataFrame], taken_at: datetime | str, columns: Sequence[str]) -> DataFrame:
        """What ``read(watermark)`` gives and has not landed, compared in ``columns`` where the reads overlap."""
        mark = self.watermark(entity, taken_at)
        if self.overlap is None or not path_exists(self.spark, f"{self.root}/landing/{entity}"):
            return read(mark)
        since = mark - self.overlap
        landed = read_landing(self.spark, f"{self.root}/landing", entity, stored_schema(entity))
        return not_landed(read(since), landed, since, *SOURCE_TIMES[entity], columns)

    def extract_table(self, entity: str, source: DataFrame, taken_at: datetime | str) -> dict | None:
        """Lands what is new or changed in a source table."""
        rows = self.unread(entity, lambda mark: incremental_rows(source, mark), taken_at, source_schema(entity).names)
        return self.land(entity, rows, taken_at)

    def land(self, entity: str, batch: DataFrame, taken_at: datetime | str, version: str = SCHEMA_VERSION) -> dict | None:
        """Checks a batch against its contract, lands it, and moves the watermark of its entity.

        The landed folder is the commit; ``watermark`` writes the record of a batch whose run stopped before it did.
        """
        checked = enforce(batch, self._sources.get((entity, version)) or source_schema(entity))
        landed = write_landing(checked, f"{self.root}/landing", entity, taken_at, *SOURCE_TIMES[entity], version)
        if landed:
            self._record(entity, as_datetime(taken_at), landed, self.watermark(entity, taken_at))
        return landed

    def _stored(self, entity: str) -> T.StructType:
        """The schema that landed files of all versions of an entity are read with."""
        if not path_exists(self.spark, f"{self.root}/landing/schemas/{entity}"):
            return stored_schema(entity)
        versions = self.versions(entity)
        if len(versions) == 1:
            return stored_schema(entity)
        kinds = {"integer": "bigint"}
        return struct({f.name: kinds.get(f.type, "string") for f in widened(versions)})

    def ingest(self, entities: Sequence[str], loaded_at: datetime | str, max_files: int | None = None) -> None:
        """Loads the waiting files of all entities into bronze, side by side; one that never landed is left out."""
        pipes = [
            start_bronze(
                self.spark,
                f"{self.root}/landing/{entity}",
                self._stored(entity),
                f"{self.root}/bronze/{entity}",
                f"{self.root}/checkpoints/bronze_{entity}",
                loaded_at,
                max_files,
            )
            for entity in entities
            if path_exists(self.spark, f"{self.root}/landing/{entity}")
        ]
        for pipe in pipes:
            pipe.awaitTermination()

    def refresh(
        self,
        entity: str,
        as_of: datetime | str,
        apply: Callable[[DataFrame, str], None],
        max_files: int | None = None,
    ) -> None:
        """Takes the unread bronze rows of an entity through dedup, typed extract and audit to ``apply``.

        ``apply(extract, batch_id)`` writes gold tables under the batch id; a batch that fails
        anywhere is delivered again and its finished commits are skipped.
        """
        if not path_exists(self.spark, f"{self.root}/bronze/{entity}"):
            return
        versions = self.versions(entity)
        table = f"{entity}_extract_cast"
        checkpoint = f"{self.root}/checkpoints/refresh_{entity}"
        if path_exists(self.spark, f"{self.root}/silver/{table}") and not path_exists(self.spark, checkpoint):
            # A new stream would number its batches from 0 again, and finished batch ids are skipped.
            raise RuntimeError(f"{checkpoint} is gone, but batches of {entity} were loaded: restore it")
        rules = [r for r in self.rules if r.table_name == table]
        if rules:
            rule_table(self.spark, rules).coalesce(1).write.mode("overwrite").json(
                f"{self.root}/data_quality/dim_tests/{table}"
            )

        def load(rows: DataFrame, batch: int) -> None:
            if rows.isEmpty():  # a micro-batch of empty files delivers nothing to audit or load
                return
            batch_id = f"{entity}-{batch}"
            extract = create_or_replace(
                first_arrivals(rows), f"{self.root}/silver/{table}/batch_id={batch}"
            )
            if rules:
                own = f"{self.root}/data_quality/fact_errors/{table}/batch_id={batch}"
                failures = create_or_replace(
                    run_audit({table: extract}, rules, as_of, self._next_failure(own)).coalesce(1), own
                )
                if self.stop_on_failure:
                    require_passed(failures)
            apply(extract, batch_id)

        consume(self.spark, f"{self.root}/bronze/{entity}", checkpoint, load, max_files, arriving_columns(versions))

    def rule_catalogue(self) -> DataFrame:
        """The rules of all audited tables, as the last run wrote them."""
        return self._recursive(RULES).json(f"{self.root}/data_quality/dim_tests")

    def failure_log(self) -> DataFrame:
        """The failures of all audited tables and batches."""
        if not path_exists(self.spark, f"{self.root}/data_quality/fact_errors"):
            return self.spark.createDataFrame([], FAILURES)
        return self._recursive(FAILURES).parquet(f"{self.root}/data_quality/fact_errors")

    def _recursive(self, schema: str) -> DataFrameReader:
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true")

    def _next_failure(self, own: str) -> int:
        """One more than the last id in the log, without those of a batch that is delivered again."""
        if not path_exists(self.spark, f"{self.root}/data_quality/fact_errors"):
            return 1
        mine = F.col("_metadata.file_path").contains(own.rsplit("/data_quality/", 1)[1] + "/")
        return (self.failure_log().where(~mine).agg(F.max("id")).first()[0] or 0) + 1
