"""Token counts of flat token files without an index, by a scan for separators.

A flat file is a run of token ids in which an end-of-document id follows every document. Files are scanned in blocks that
know nothing of documents: a vectorised search finds the separators of a block, and a prefix scan over the blocks of
a file (first inside runs of blocks, then over the runs) stitches the documents that cross boundaries.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shuffle_width, workspace

# Fixed values of the public byte-level vocabulary: how text is split, and its end-of-document id.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
BLOCK = 1 << 16
RUN = 1024
#: Blocks of a file that are read as one range.
RANGE = 64


@cache
def _encoding(rank_file: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    if max(ranks.values(), default=0) > 0xFFFF:
        raise ValueError("the vocabulary has ids above 65535, which flat files of 16-bit ids cannot hold")
    return tiktoken.Encoding("flat", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def _files(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def _flat(rank_file: str, folder: str):
    """Writes a token file per task and gives its documents' order; a task that is tried again writes another file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, ordinal = _encoding(rank_file), 0
        file = f"{folder}/{uuid.uuid4().hex}.ids"
        system, place = _files(file)
        with system.open_output_stream(place) as out:
            for whole in batches:
                for at in range(0, whole.num_rows, 500):
                    batch = whole.slice(at, 500)
                    for text in batch.column("text").to_pylist():
                        out.write(np.array([*encoding.encode_ordinary(text or ""), END], dtype="<u2").tobytes())
                    ids = batch.column("doc_id")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file] * len(ids), pa.string()), pa.array(range(ordinal, ordinal + len(ids)), pa.int64()), ids], names=["file", "ordinal", "doc_id"]
                    )
                    ordinal += len(ids)

    return run


def write_flat(documents: DataFrame, folder: str, rank_file: str) -> DataFrame:
    """Writes flat files of 16-bit ids of ``documents`` to ``folder``/flat, one per task, and gives (file, ordinal, doc_id).

    The order of the documents is a table beside the files, which know nothing of it: nor where a document ends, but for
    its separator. Files of attempts that failed are named nowhere. A missing text is an empty document. The folder must
    be one that all executors share, on a file system that pyarrow opens.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    system, place = _files(folder)
    system.create_dir(f"{place}/flat", recursive=True)
    rows.mapInArrow(_flat(rank_file, f"{folder}/flat"), "file string, ordinal long, doc_id long").write.parquet(f"{folder}/order")
    return documents.sparkSession.read.parquet(f"{folder}/order")


def _ranges(block: int):
    """Reads ranges (file, start, length) and cuts them into blocks, numbered by their place in the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _files(row["file"])
                with system.open_input_file(place) as source:
                    for at in range(row["start"], row["start"] + row["length"], 2 * block):
                        content = source.read_at(min(2 * block, row["start"] + row["length"] - at), at)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["file"]], pa.string()), pa.array([at // (2 * block)], pa.int64()), pa.array([content], pa.binary())],
                            names=["file", "block", "ids"],
                        )

    return run


def blocks_of(spark: SparkSession, path: str, block: int = BLOCK, range_blocks: int = RANGE) -> DataFrame:
    """(file, block, ids) of binary files of 16-bit little-endian ids, whatever their size; ``file`` is the path.

    Only the sizes of the files are listed. Each range of ``range_blocks`` blocks is a row of its own, read by the task that
    gets it, so that one large file is spread over all tasks; a block's number follows from its offset. An odd last
    byte is no id.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length")
    step = 2 * block * range_blocks
    whole = F.col("length") - F.col("length") % 2
    starts = F.explode(F.sequence(F.lit(0).cast("long"), whole - 1, F.lit(step).cast("long")))
    ranges = files.filter(whole > 0).select("file", whole.alias("size"), starts.alias("start"))
    ranges = ranges.select("file", "start", F.least(F.lit(step).cast("long"), F.col("size") - F.col("start")).alias("length"))
    # A fixed number of partitions: the rows are tiny, and adaptive execution would put all of them into one task.
    return ranges.repartition(shuffle_width(spark), "file", "start").mapInArrow(_ranges(block), "file string, block long, ids binary")


def _separators(end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(b, "<u2") for b in batch.column("ids").to_pylist()]
            ends = [np.flatnonzero(ids == end) for ids in found]
            offsets = np.concatenate([[0], np.cumsum([len(e) for e in ends])]).astype(np.int32)
            flat = np.concatenate([*ends, np.zeros(0, np.int64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array([len(i) for i in found], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["file", "block", "size", "ends"],
            )

    return run


def counted(blocks: DataFrame, folder: str, end: int = END, run_length: int = RUN) -> DataFrame:
    """(file, ordinal, start, n_tokens, closed) of every document of the blocks (file, block, ids).

    ``start`` and ``n_tokens`` count ids within the file, separators left out of the counts. Ids after the last separator
    are a document that is not closed. Separators found are written to ``folder``, as two scans read them. An
    empty block counts nothing; files are told apart by ``file`` alone, which may be of any type.
    """
    spark = blocks.sparkSession
    kind = blocks.schema["file"].dataType.simpleString()
    blocks.mapInArrow(_separators(end), f"file {kind}, block long, size long, ends array<long>").write.parquet(f"{folder}/separators")
    found = spark.read.parquet(f"{folder}/separators").withColumn("run", F.expr(f"block div {run_length}"))
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = found.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0))).withColumn("nth", F.coalesce(F.sum(F.size("ends")).over(inside), F.lit(0)))
    last = F.when(F.size("ends") > 0, F.col("at") + F.element_at("ends", -1))  # place of the block's last separator in its run
    first = first.withColumn("last", last).withColumn("before", F.max("last").over(inside))
    totals = found.groupBy("file", "run").agg(F.sum("size").alias("run_size"), F.sum(F.size("ends")).cast("long").alias("run_ends"))
    tails = first.groupBy("file", "run").agg(F.max("last").alias("run_last"))
    runs = totals.join(tails, ["file", "run"])
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_at", F.coalesce(F.sum("run_size").over(earlier), F.lit(0)))
    runs = runs.withColumn("run_nth", F.coalesce(F.sum("run_ends").over(earlier), F.lit(0)))
    runs = runs.withColumn("run_before", F.max(F.col("run_at") + F.col("run_last")).over(earlier))
    # Every file's last run also knows what follows its last separator.
    stitched = first.join(runs, ["file", "run"]).select(
        "file",
        F.coalesce(F.col("run_at") + F.col("before"), "run_before", F.lit(-1)).alias("previous"),
        (F.col("run_nth") + F.col("nth")).alias("nth"),
        F.transform("ends", lambda e: e + F.col("run_at") + F.col("at")).alias("ends"),
    )
    each = stitched.filter(F.size("ends") > 0).select("file", "nth", "previous", "ends", F.posexplode("ends").alias("i", "stop"))
    begin = F.when(F.col("i") == 0, F.col("previous")).otherwise(F.get("ends", F.col("i") - 1)) + 1
    closed = each.select("file", (F.col("nth") + F.col("i")).alias("ordinal"), begin.alias("start"), (F.col("stop") - begin).alias("n_tokens"), F.lit(True).alias("closed"))
    whole = runs.groupBy("file").agg(F.sum("run_size").alias("size"), F.sum("run_ends").alias("ordinal"), F.max(F.col("run_at") + F.col("run_last")).alias("final"))
    start = F.coalesce(F.col("final"), F.lit(-1)) + 1
    open_ones = whole.select("file", "ordinal", start.alias("start"), (F.col("size") - start).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.union(open_ones.filter("n_tokens > 0"))


def digest(spark: SparkSession, documents: DataFrame, rank_file: str) -> DataFrame:
    """Token count of every document, found in the flat files alone; the documents' order beside them then gives the ids."""
    folder = workspace(spark, "token-counts")
    order = write_flat(documents, folder, rank_file)
    if order.isEmpty():
        return spark.createDataFrame([], "doc_id long, file string, ordinal long, start long, n_tokens long")
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    counts = counted(blocks_of(spark, f"{folder}/flat").withColumn("file", name("file")), folder)
    order = order.withColumn("file", name("file"))
    # Files that failed attempts left behind are in no order, and fall out here.
    return order.join(counts.hint("merge"), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
