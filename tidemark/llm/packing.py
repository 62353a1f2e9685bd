"""Best-fit packing under conflicts.

Pieces of documents go into bins of a fixed number of tokens. Bins of a group are ordered by what they have left; a bin
carries a bitmap of the duplicate clusters and one of the sources in it. A piece takes the first bin from its own length
upwards whose bitmaps do not clash with it, which is the tightest compatible bin, else a new one.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.skew import join_aggregate
from tidemark.llm.words import LOWER, all_shingles, mix, spans, text_bytes, word_hashes
from tidemark.session import workspace

CAPACITY = 4096
#: Documents of one source in a bin, at most; of one duplicate cluster always one.
PER_SOURCE = 16
#: Documents that are packed together; each group is one task's work whatever the corpus.
GROUP_ROWS = 2000
#: Near copies: words of a shingle, bands of minima and minima of a band.
WIDTH, BANDS, ROWS = 5, 26, 7
TEXTS_AT_ONCE = 256
_AWAY, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def pack(pieces: Iterable[tuple[int, object, object]], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each (length, cluster, source), which must come by falling length.

    ``cluster`` or ``source`` None clashes with nothing. A source has ``per_source`` bits, of which a document of it
    takes one that is free in the bin. Only clusters and sources that can clash here get bits.
    """
    pieces = list(pieces)
    clusters, sources = Counter(p[1] for p in pieces), Counter(p[2] for p in pieces)
    cluster_bit = {c: 1 << i for i, c in enumerate(c for c, n in clusters.items() if c is not None and n > 1)}
    lanes = {s: i * per_source for i, s in enumerate(s for s, n in sources.items() if s is not None and n > per_source)}
    one = (1 << per_source) - 1
    order: list[tuple[int, int]] = []  # (left, bin), ascending
    cluster_map: list[int] = []
    source_map: list[int] = []
    left: list[int] = []
    placed = []
    last, resume = None, (0, -1)
    for length, cluster, source in pieces:
        bit, lane = cluster_bit.get(cluster, 0), lanes.get(source)
        # After a piece of the same length, cluster and source, its own bin clashes as well as those that clashed before.
        same = (length, cluster, source)
        at = bisect_left(order, resume if bit and same == last else (length, -1))
        while at < len(order):
            number = order[at][1]
            if not cluster_map[number] & bit and (lane is None or (source_map[number] >> lane) & one != one):
                break
            at += 1
        if at < len(order):
            rest, number = order.pop(at)
            resume = (rest, number)
        else:
            rest, number = capacity, len(left)
            left.append(capacity)
            cluster_map.append(0)
            source_map.append(0)
            resume = (capacity, number)
        placed.append((number, capacity - rest))
        cluster_map[number] |= bit
        if lane is not None:
            used = (source_map[number] >> lane) & one
            source_map[number] |= (~used & (used + 1)) << lane
        left[number] = rest - length
        if left[number] > 0:
            insort(order, (left[number], number))
        last = same
    return placed


def packed(
    documents: DataFrame,
    length: Column,
    cluster: Column,
    source: Column,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: doc_id, version, part, start, length, bin, offset.

    A document longer than a bin is cut into full bins and a rest; all its parts carry its cluster and source, so that
    they, too, lie in different bins. Documents of no length get part 0 with bin -1 and offset 0. Groups of about
    ``group_rows`` documents, by a hash of id and text, are packed side by side, and a bin belongs to one group:
    a hot source or cluster spreads over all groups, and no group grows with the corpus. An empty table gives no row.
    Rows repeated with the same id and text are packed one by one. Equal lengths go by cluster, source and id.
    A very long text is measured whole and cut like any other.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("version"),
        F.coalesce(length, F.lit(0)).cast("long").alias("tokens"),
        cluster.alias("cluster"),
        source.alias("source"),
    )
    return _packed(rows.filter("tokens > 0"), rows.filter("tokens <= 0"), documents.count(), capacity, per_source, group_rows)


def _packed(filled: DataFrame, empty: DataFrame, total: int, capacity: int, per_source: int, group_rows: int) -> DataFrame:
    """``packed`` of ``total`` rows: ``filled`` of doc_id, version, tokens, cluster and source, and those of no length.

    Rows that are repeated with the same id and text travel as one row with its number of times, ``group_rows`` at most.
    """
    groups = max(1, -(-total // group_rows))
    empty = empty.selectExpr("doc_id", "version", "0L part", "0L start", "0L length", "-1L bin", "0L offset")
    counted = filled.groupBy("doc_id", "version", "tokens", "cluster", "source").agg(F.count("*").alias("times"))
    lots = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {group_rows}")))
    filled = counted.withColumn("lot", lots).withColumn("times", F.least(F.lit(group_rows), F.col("times") - F.col("lot") * group_rows))
    filled = filled.withColumn("group", F.pmod(F.xxhash64("doc_id", "version", "cluster", "source", "lot"), F.lit(groups)))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {capacity}")))
    pieces = filled.withColumn("part", parts).withColumn("start", F.col("part") * capacity)
    pieces = pieces.withColumn("length", F.least(F.lit(capacity), F.col("tokens") - F.col("start"))).drop("tokens", "lot")

    def one_group(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.loc[frame.index.repeat(frame["times"])]
        frame = frame.sort_values(["length", "cluster", "source", "doc_id", "version", "part"], ascending=[False, True, True, True, True, True], kind="stable")
        none = lambda c: frame[c].astype(object).where(frame[c].notna(), None)
        placed = pack(zip(frame["length"].tolist(), none("cluster").tolist(), none("source").tolist()), capacity, per_source)
        frame = frame.assign(bin=[(int(frame["group"].iloc[0]) << 32) + b for b, _ in placed], offset=[o for _, o in placed])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame[["doc_id", "version", "part", "start", "length", "bin", "offset"]]

    schema = "doc_id long, version long, part long, start long, length long, bin long, offset long"
    return pieces.groupBy("group").applyInPandas(one_group, schema).union(empty)


def word_count(text: str = "text") -> Column:
    """Words without white space inside and one separator, the length that the queries pack; a text without words has none."""
    words = F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), ""))
    return F.when(words > 0, words + 1).otherwise(0)


def band_keys(shingles: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """(texts, bands): a key for each band of minima of every text, from its shingles; texts without any have no use of theirs.

    One hash per shingle: its place decides the bin, the least value of a bin is its minimum, and an empty bin borrows the
    minimum of one that its own number draws. Two sets agree in a bin with about the probability of their Jaccard
    similarity, and share one of ``BANDS`` bands of ``ROWS`` bins with 0.998 at 0.8 and 0.2 at 0.5.
    """
    size, none = BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF)
    values = mix(shingles)
    bins = ((values >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
    minima = np.full(texts * size, none)
    np.minimum.at(minima, owner * size + bins, values)
    empty = np.flatnonzero(minima == none)
    worded = np.zeros(texts, dtype=bool)
    worded[owner] = True
    empty = empty[worded[empty // size]]
    own, draw = minima != none, np.arange(size, dtype=np.uint64)
    while len(empty):
        draw = mix(draw * _STEP + _AWAY)
        number = empty % size
        source = empty - number + (draw[number] % np.uint64(size)).astype(np.int64)
        hit = own[source]
        minima[empty[hit]] = mix(minima[source[hit]] + number[hit].astype(np.uint64))
        empty = empty[~hit]
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (texts, BANDS))
    for row in minima.reshape(texts, ROWS, BANDS).transpose(1, 0, 2):
        keys = mix(keys * _STEP + row)
    return keys


def _measured(near: bool):
    """Adds the number of words and, if ``near``, the band keys of the five-word shingles of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                data, ends = text_bytes(batch.column("text"))
                first, last, words = spans(data, ends)
                count = np.diff(words)
                with_keys = (count > 0) & near
                keys = np.zeros((0, BANDS), np.uint64)
                if near:
                    keys = band_keys(*all_shingles(word_hashes(LOWER[data], first, last), words, WIDTH), batch.num_rows)[with_keys]
                ends = np.concatenate([[0], np.cumsum(np.where(with_keys, BANDS, 0))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel().view(np.int64)))
                columns = [batch.column(c) for c in ("doc_id", "version", "source")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.where(count > 0, count + 1, 0).astype(np.int64)), lists], names=["doc_id", "version", "source", "tokens", "bands"]
                )

    return run


def measured(documents: DataFrame, near: bool, folder: str) -> DataFrame:
    """doc_id, version, source, tokens (words and one separator; 0 without words) and bands of every row, from one pass."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"),
        F.col("source").cast("string").alias("source"), "text",
    )
    schema = "doc_id long, version long, source string, tokens long, bands array<long>"
    rows.mapInArrow(_measured(near), schema).write.parquet(f"{folder}/measured")
    return documents.sparkSession.read.parquet(f"{folder}/measured")


def _clusters(rows: DataFrame, folder: str) -> DataFrame:
    """(node, component) of the versions that share a band key with another one, also over others.

    Copies of a text give a key once. Every text of a key points at the least one, so that a very common key gives as
    many links as it has different texts.
    """
    marks = rows.select("version", F.explode("bands").alias("key")).distinct()
    marks.write.parquet(f"{folder}/marks")
    marks = rows.sparkSession.read.parquet(f"{folder}/marks")
    shared = marks.groupBy("key").agg(F.min("version").alias("least"), F.max("version").alias("most")).filter("least < most")
    links = join_aggregate(marks, shared.drop("most"), "key").select(F.col("version").alias("a"), F.col("least").alias("b"))
    return components(links.distinct(), f"{folder}/components")


def near_copies(documents: DataFrame) -> DataFrame:
    """version (a hash of the text) and cluster, once for every text: the smallest version among its near copies.

    Near copies share a band of minima of their five-word shingles (words in lower case, A-Z only), also over others; a
    text of fewer words is one shingle. Pairs at a similarity of 0.8 are found with a probability of about 0.998, more alike
    ones nearly always; less alike pairs that meet by chance (a fifth at 0.5) are only kept apart in bins. A text without words, or a
    missing one, is in a cluster of its exact copies.
    """
    folder = workspace(documents.sparkSession, "packing")
    rows = measured(documents.withColumn("doc_id", F.lit(0)).withColumn("source", F.lit("")).select("doc_id", "source", "text"), True, folder)
    return _clustered(rows.select("version").distinct(), rows, folder)


def _clustered(versions: DataFrame, rows: DataFrame, folder: str) -> DataFrame:
    """Adds the cluster to rows that have a version."""
    found = _clusters(rows, folder).select(F.col("node").alias("version"), "component")
    joined = join_aggregate(versions, found, "version", how="left")
    return joined.withColumn("cluster", F.coalesce("component", "version")).drop("component")


def digest(documents: DataFrame, near: bool = True) -> DataFrame:
    """Pieces of every document; near copies of a text are a cluster, or only its exact copies where ``near`` is false."""
    folder = workspace(documents.sparkSession, "packing")
    rows = measured(documents, near, folder)
    plain = rows.drop("bands")
    filled = plain.filter("tokens > 0")
    filled = _clustered(filled, rows, folder) if near else filled.withColumn("cluster", F.col("version"))
    return _packed(filled, plain.filter("tokens <= 0"), rows.count(), CAPACITY, PER_SOURCE, GROUP_ROWS).drop("version")
