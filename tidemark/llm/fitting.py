"""Models that are fitted in a task on a bounded sample."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fitted(sample: DataFrame, fit: Callable[[list[tuple]], Any]) -> Any:
    """``fit`` of all rows of ``sample``, in no given order; an empty one gives ``fit`` of no rows.

    One task holds the rows and the arrays that fitting needs, so ``sample`` must be bounded; the driver gets the model alone.
    """
    # A row that is none, as Spark leaves out a step over a table that it finds to be empty.
    none = sample.sparkSession.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in sample.schema))
    marked = sample.withColumn("__real", F.lit(True)).union(none.withColumn("__real", F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r[:-1] for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)) if r[-1]]
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(pickle.dumps(fit(rows)), 1)], pa.binary())], names=["model"])

    (found,) = marked.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(zlib.decompress(found["model"]))
