"""N-gram Jaccard join by parity sketches.

Every shingle toggles one bit of a wide sketch of its document, so that the Hamming distance of two sketches never
exceeds the symmetric difference of their sets. For a size band the difference that the threshold allows is at
most H; the sketch is cut into more than H parts, and by the pigeonhole principle two linked documents of the band
agree in one part at least. A part is too wide to be stored as bits; it is held as the XOR of the 64-bit codes of its
toggled bits, which equal parts share. Documents meet where a part agrees. A 512-bit sketch and, of larger sets, one
of at least as many bits as shingles, filtered by their Hamming distances, and the exact sets then decide.

Equal sets are one node from the start. Documents that share a part are not all paired: each meets a pivot of the
part, linked ones become one component, and only documents whose components still differ are paired, so that
groups of near copies cost about as many checks as they have members, while no link between components is lost.

Texts are fetched for the nodes of near pairs alone, and pairs are checked in lots whose texts are no more than those of
the table, so that the disk follows the table and not the number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import remove
from tidemark.llm.components import components
from tidemark.llm.skew import join_aggregate
from tidemark.llm.words import mix, shingle_sets
from tidemark.session import shuffle_width, workspace

SKETCH_WORDS = 8
ROWS_AT_ONCE = 500
PIVOT_ROUNDS = 2
MORE_PIVOT_ROUNDS = 3


def allowed_difference(a: int, b: int, percent: int) -> int:
    """Most shingles in which linked sets of ``a`` and ``b`` shingles can differ."""
    return (100 - percent) * (a + b) // (100 + percent)


def size_bands(percent: int, largest: int = 1 << 40) -> list[int]:
    """Least sizes of the bands; a linked pair lies in one band or in two that follow each other."""
    least, ratio = [1], max(125, -(-10000 // percent))
    while least[-1] <= largest:
        least.append(max(least[-1] + 1, -(-least[-1] * ratio // 100)))
    return least


def part_keys(shingles: np.ndarray, percent: int, bands: list[int]) -> np.ndarray:
    """Keys of the sketch's parts, for the band of the set and, where a larger partner can be there, the next one."""
    size, out = len(shingles), []
    own = int(np.searchsorted(bands, size, side="right")) - 1
    for band in (own, own + 1):
        if band > own and 100 * size < percent * bands[band]:
            break
        most = allowed_difference(bands[band + 1] - 1, bands[band + 1] - 1, percent)
        if most == 0:
            continue  # only equal sets, which are one node
        count = most + 2 + most // 12
        part = ((shingles >> np.uint64(32)) % np.uint64(count)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        filled, starts = np.unique(part[order], return_index=True)
        words = np.bitwise_xor.reduceat(shingles[order], starts)
        if len(filled) <= most:  # agreement could be in empty parts alone: these count too
            whole = np.zeros(count, dtype=np.uint64)
            whole[filled] = words
            filled, words = np.arange(count), whole
        out.append(mix(words ^ mix(filled.astype(np.uint64) + np.uint64(band << 40) + np.uint64(1))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def sketch(shingles: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parities of the shingles by their lower bits; the XOR of its halves is the sketch of half as many words."""
    bits = np.bincount((shingles & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray) -> np.ndarray:
    """A sketch of at least as many bits as shingles, a power of two; empty where the plain one has as many.

    Half the bits of a full sketch differ between any two sets: of 512 bits 256, which a link allows from 1,152 shingles on
    (at 80 percent). Of a bit per shingle or more, unrelated sets differ in twice as many as a link allows.
    """
    words = 1 << max(0, (len(shingles) - 1).bit_length() - 6)
    return sketch(shingles, words) if words > SKETCH_WORDS else np.zeros(0, np.int64)


def _packed(keys: np.ndarray, sums: np.ndarray) -> tuple[bytes, bytes]:
    """Upper 40 bits of the keys and the sums of their sets; the bucket tells the rest of a key well enough."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes(), sums.astype("<u8").tobytes()


def _long_keys(upper: np.ndarray, bucket: np.ndarray | int) -> np.ndarray:
    return ((upper << np.uint64(23)) | np.asarray(bucket, dtype=np.uint64)).view(np.int64)


def _sketched(width: int, percent: int, buckets: int):
    """One row per document, then the part keys of each Arrow batch as one packed row per bucket.

    Of a key that several sets of a batch share, only one set goes on; the sets keep such keys (``local_keys``)
    themselves. So a very common part sends a bucket one entry per batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = size_bands(percent)
        for whole in batches:
            sizes, sums, sketches, keys = [], [], [], []
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                for s in shingle_sets(whole.column("text").slice(at, ROWS_AT_ONCE), width):
                    sizes.append(len(s))
                    sums.append((s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s + np.uint64(1)))) if len(s) else (0, 0))
                    sketches.append(np.concatenate([sketch(s), wide_sketch(s)]))
                    keys.append(part_keys(s, percent, bands) if len(s) else np.zeros(0, np.uint64))
            if not sizes:
                continue
            sums = np.array(sums, dtype=np.uint64).reshape(-1, 2)
            flat, owner = np.concatenate(keys), np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            bucket, upper = flat % np.uint64(buckets), flat >> np.uint64(24)
            order = np.lexsort((sums[owner, 0], upper, bucket))
            bucket, upper, owner, flat = bucket[order], upper[order], owner[order], flat[order]
            own_sums = sums[owner, 0]
            new_key = np.ones(len(flat), dtype=bool)
            new_key[1:] = (bucket[1:] != bucket[:-1]) | (upper[1:] != upper[:-1])
            run_number = np.cumsum(new_key) - 1
            first = np.flatnonzero(new_key)
            ends = np.append(first[1:], len(flat)) - 1
            shared = (own_sums[first] != own_sums[ends])[run_number] if len(flat) else np.zeros(0, bool)
            by_owner = np.argsort(owner[shared], kind="stable")
            local = _long_keys(upper[shared], bucket[shared])[by_owner]
            local_ends = np.cumsum([0, *np.bincount(owner[shared], minlength=len(keys))])
            sketch_ends = np.cumsum([0, *(len(x) for x in sketches)])
            n = len(keys)
            none = lambda kind, size=n: pa.nulls(size, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    whole.column("doc_id"),
                    whole.column("version"),
                    pa.array(sizes, pa.int64()),
                    pc.fill_null(pc.binary_length(whole.column("text")), 0).cast(pa.int64()),
                    pa.array(np.ascontiguousarray(sums[:, 0]).view(np.int64)),
                    pa.array(np.ascontiguousarray(sums[:, 1]).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(sketch_ends, pa.int32()), pa.array(np.concatenate(sketches))),
                    pa.ListArray.from_arrays(pa.array(local_ends, pa.int32()), pa.array(local)),
                    none(pa.int64()),
                    none(pa.binary()),
                    none(pa.binary()),
                ],
                names=ROW_NAMES,
            )
            edges = np.flatnonzero(np.append(True, bucket[first][1:] != bucket[first][:-1])) if len(first) else np.zeros(0, int)
            parts = [(int(bucket[rows[0]]), *_packed(flat[rows], own_sums[rows])) for rows in np.split(first, edges[1:]) if len(rows)]
            if parts:
                m = len(parts)
                numbers, packed, packed_sums = zip(*parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(none(pa.int64(), m) for _ in range(6)),
                        *(none(pa.list_(pa.int64()), m) for _ in range(2)),
                        pa.array(numbers, pa.int64()),
                        pa.array(packed, pa.binary()),
                        pa.array(packed_sums, pa.binary()),
                    ],
                    names=ROW_NAMES,
                )

    return run


ROW_NAMES = ["doc_id", "version", "n_shingles", "n_bytes", "sum", "xor", "sketch", "local_keys", "bucket", "keys", "sums"]
ROW_SCHEMA = (
    "doc_id long, version long, n_shingles long, n_bytes long, sum long, xor long, sketch array<long>, local_keys array<long>, "
    "bucket long, keys binary, sums binary"
)


def _shared(key: tuple, table: pa.Table) -> pa.Table:
    """(key, sum) of the keys of a bucket that different sets have."""
    packed = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint8).reshape(-1, 5)
    upper = np.zeros((len(packed), 8), dtype=np.uint8)
    upper[:, :5] = packed
    upper = upper.view("<u8").ravel()
    sums = np.frombuffer(b"".join(table.column("sums").to_pylist()), "<u8")
    order = np.lexsort((sums, upper))
    upper, sums = upper[order], sums[order]
    new_pair = np.ones(len(upper), dtype=bool)
    new_pair[1:] = (upper[1:] != upper[:-1]) | (sums[1:] != sums[:-1])
    upper, sums = upper[new_pair], sums[new_pair]
    twin = np.zeros(len(upper), dtype=bool)
    same = upper[1:] == upper[:-1]
    twin[1:] |= same
    twin[:-1] |= same
    return pa.table({"key": _long_keys(upper[twin], key[0].as_py()), "sum": sums[twin].view(np.int64)})


def _verified(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                linked = []
                for s, t in zip(shingle_sets(batch.column("text_a"), width), shingle_sets(batch.column("text_b"), width)):
                    common = len(np.intersect1d(s, t, assume_unique=True))
                    linked.append(100 * common >= percent * (len(s) + len(t) - common))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    return run


def _wide_distance() -> Column:
    """Bits in which the wide sketches of sides ``x`` and ``y`` differ; one of twice as many words is folded."""
    words = F.least(F.size("x.wide"), F.size("y.wide"))

    def fit(wide: Column) -> Column:
        halves = F.slice(wide, F.lit(1), words), F.slice(wide, words + 1, words)
        return F.when(F.size(wide) > words, F.zip_with(*halves, lambda p, q: p.bitwiseXOR(q))).otherwise(wide)

    differ = F.zip_with(fit(F.col("x.wide")), fit(F.col("y.wide")), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return F.aggregate(differ, F.lit(0), lambda total, n: total + n)


def _close(percent: int) -> Column:
    """Sizes and sketches of sides ``x`` and ``y`` allow a link; the wide ones are looked at last."""
    total = F.col("x.n_shingles") + F.col("y.n_shingles")
    words = [F.bit_count(F.col(f"x.s{i}").bitwiseXOR(F.col(f"y.s{i}"))) for i in range(SKETCH_WORDS)]
    smaller, larger = F.least("x.n_shingles", "y.n_shingles"), F.greatest("x.n_shingles", "y.n_shingles")
    near = lambda distance: distance * (100 + percent) <= (100 - percent) * total
    plain = (100 * smaller >= percent * larger) & near(reduce(lambda p, q: p + q, words))
    sizes = F.size("x.wide"), F.size("y.wide")
    comparable = (F.least(*sizes) > 0) & (F.greatest(*sizes) <= 2 * F.least(*sizes))
    return F.when(plain, F.when(comparable, near(_wide_distance())).otherwise(True)).otherwise(False)


def _keyed(documents: DataFrame) -> DataFrame:
    """With two hashes that tell rows apart by id and text; neither is ever missing."""
    keyed = documents.withColumn("__version", F.xxhash64("text"))
    return keyed.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), "__version"))


class _Join:
    """One run's tables in the shared folder."""

    def __init__(self, spark: SparkSession, documents: DataFrame, width: int, percent: int):
        self.spark, self.width, self.percent = spark, width, percent
        self.folder = workspace(spark, "ngram-join")
        self.documents = documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text")
        )

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        # Spark deletes the shuffle files of earlier tables when the driver's collector finds that nothing reads them any
        # more; left to itself it runs so seldom that the files of all rounds lie on disk together.
        self.spark._jvm.System.gc()
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def dropped(self, name: str) -> None:
        """A table that no later one reads."""
        remove(self.spark, f"{self.folder}/{name}")

    def labels(self, links: list[DataFrame], name: str) -> DataFrame:
        return components(reduce(DataFrame.union, [x.filter("linked").select("a", "b") for x in links]), f"{self.folder}/{name}")

    def run(self) -> DataFrame:
        buckets = min(shuffle_width(self.spark), 1 << 23)
        sketched = self.documents.mapInArrow(_sketched(self.width, self.percent, buckets), ROW_SCHEMA)
        sketched = sketched.withColumn("row", F.monotonically_increasing_id()).withColumn("packed", F.col("bucket").isNotNull())
        # In folders of their own: the packed keys are most of the table and go as soon as they have met.
        sketched.write.option("compression", "zstd").partitionBy("packed").parquet(f"{self.folder}/rows")
        sketched = self.spark.read.schema(sketched.schema).parquet(f"{self.folder}/rows")
        rows = sketched.filter("not packed").drop("bucket", "keys", "sums", "packed")
        same = ["n_shingles", "sum", "xor"]
        nodes = self.stored("nodes", rows.filter("n_shingles > 0").groupBy(*same).agg(F.min("row").alias("node"), F.min("doc_id").alias("least_id")))
        packed = sketched.filter("packed").select("bucket", "keys", "sums")
        shared = packed.groupBy("bucket").applyInArrow(_shared, "key long, sum long")
        local = rows.filter(F.size("local_keys") > 0).select(F.explode("local_keys").alias("key"), "sum")
        # Equal sets have equal sums; different sets with one sum would only meet more often.
        shared = shared.union(local).distinct()
        buckets = self.stored("buckets", shared.join(nodes.select("sum", "node").hint("merge"), "sum").select("key", "node"))
        self.dropped("rows/packed=true")
        members = self.stored("members", self.members(buckets, rows))
        self.lot_bytes = max(1, rows.agg(F.sum("n_bytes")).first()[0] or 0)
        links: list[DataFrame] = []
        for turn in range(PIVOT_ROUNDS + MORE_PIVOT_ROUNDS):
            labelled = self.labelled(buckets, links, f"labels-{turn}")
            pairs = self.pivot_pairs(labelled, turn)
            links.append(self.verified(f"{turn}", self.close_pairs(pairs, members), members, links))
            # While pivots still link, another one is cheaper than what each node left over costs: a pair with all of its group.
            checked, joined = links[-1].agg(F.count("*"), F.count_if("linked")).first()
            if turn + 1 >= PIVOT_ROUNDS and 20 * joined <= checked:
                break
        labelled = self.labelled(buckets, links, "labels-rest")
        links.append(self.verified("rest", self.rest(labelled, members), members, links))
        labels = self.labels(links, "labels")
        named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        names = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
        named = self.stored("named", join_aggregate(named, names, "component").select(*same, "component", "component_id"))
        found = rows.filter("n_shingles > 0").select("doc_id", "version", *same).join(named.hint("merge"), same)
        empty = rows.filter("n_shingles = 0").select("doc_id", "version", "n_shingles", F.lit(None).cast("long"), F.col("doc_id"))
        return found.select("doc_id", "version", "n_shingles", "component", "component_id").union(empty)

    def members(self, buckets: DataFrame, rows: DataFrame) -> DataFrame:
        """Size, sketches and row hashes of the nodes that share a part with another."""
        wanted = rows.join(buckets.select(F.col("node").alias("row")).distinct(), "row", "left_semi")
        plain = [F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(SKETCH_WORDS)]
        wide = F.slice("sketch", F.lit(SKETCH_WORDS + 1), F.size("sketch") - SKETCH_WORDS).alias("wide")
        return wanted.select(F.col("row").alias("node"), F.xxhash64("doc_id", "version").alias("id"), F.col("version").alias("of"), "n_shingles", "n_bytes", *plain, wide)

    def texts(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        """Text and its length of the nodes of ``pairs``."""
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        wanted = members.select("node", "id", "of").join(nodes.hint("merge"), "node", "left_semi")
        documents = _keyed(self.documents.drop("version"))
        on = (documents["__row"] == wanted["id"]) & (documents["__version"] == wanted["of"])
        # Repeated rows give a node's text several times.
        return documents.join(wanted.hint("merge"), on).dropDuplicates(["__row", "__version"]).select("node", "text")

    def labelled(self, buckets: DataFrame, links: list[DataFrame], name: str) -> DataFrame:
        """Rows of the parts in which components still differ."""
        if not links:
            return buckets.withColumn("component", F.col("node"))
        labels = self.stored(name, self.labels(links, f"{name}-steps"))
        named = buckets.join(labels.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
        return self.stored(f"{name}-mixed", join_aggregate(named, mixed.select("key"), "key").select("key", "node", "component"))

    def pivot_pairs(self, labelled: DataFrame, turn: int) -> DataFrame:
        """Each member of a part with the pivot, a node that a hash draws, where their components differ."""
        drawn = F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"), F.col("component").alias("label"))
        pivots = labelled.groupBy("key").agg(F.min(drawn).alias("pivot")).select("key", "pivot.node", "pivot.label").withColumnRenamed("node", "pivot")
        met = join_aggregate(labelled, pivots, "key").filter("component <> label")
        return met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()

    def close_pairs(self, pairs: DataFrame, members: DataFrame) -> DataFrame:
        small = members.drop("id", "of")
        x, y = (small.select(F.col("node").alias(side), *[c for c in small.columns if c != "node"]).alias(of) for side, of in (("a", "x"), ("b", "y")))
        joined = pairs.alias("p").join(x.hint("merge"), F.col("p.a") == F.col("x.a")).join(y.hint("merge"), F.col("p.b") == F.col("y.b"))
        return joined.filter(_close(self.percent)).select("p.a", "p.b", (F.col("x.n_bytes") + F.col("y.n_bytes")).alias("n_bytes"))

    def rest(self, labelled: DataFrame, members: DataFrame) -> DataFrame:
        """All pairs of a part whose components differ, sizes fit and sketches are near: with one side outside the part's
        most common component, for two nodes of that component are linked already."""
        counts = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
        major = counts.groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("major"))
        small = members.drop("id", "of")
        wide = self.stored("wide", join_aggregate(labelled, major, "key").join(small.hint("merge"), "node").withColumn("minor", F.col("component") != F.col("major")))
        x, y = wide.filter("minor").alias("x"), wide.alias("y")
        once = ~F.col("y.minor") | (F.col("x.node") < F.col("y.node"))
        on = (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component")) & once & _close(self.percent)
        pairs = x.join(y.hint("merge"), on)
        both = (F.col("x.n_bytes") + F.col("y.n_bytes")).alias("n_bytes")
        return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"), both).distinct()

    def verified(self, name: str, pairs: DataFrame, members: DataFrame, before: list[DataFrame]) -> DataFrame:
        """(a, b, linked) by the exact sets, for pairs that no earlier round has decided."""
        # A table of near pairs: else Spark moves the joins below the filter by sketches, to all members of all parts.
        pairs = self.stored(f"pairs-{name}", pairs)
        for known in before:
            pairs = pairs.join(known.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        texts = self.stored(f"texts-{name}", self.texts(pairs, members))
        # Each pair takes two texts to its check. Their shuffle files are those of one lot, at most as large as the table.
        lots = -(-(pairs.agg(F.sum("n_bytes")).first()[0] or 0) // self.lot_bytes) or 1
        side = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}")).hint("merge")
        links = []
        for lot in range(lots):
            some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(lots)) == lot) if lots > 1 else pairs
            both = some.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
            checked = both.mapInArrow(_verified(self.width, self.percent), "a long, b long, linked boolean")
            links.append(self.stored(f"links-{name}" + f"-{lot}" * (lot > 0), checked))
        self.dropped(f"texts-{name}")
        return reduce(DataFrame.union, links)


def linked(spark: SparkSession, documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, version (a hash of the text), n_shingles, component and component_id of every row of ``documents``.

    Words are runs without white space, A-Z in lower case; the set of a text is its distinct ``width``-word shingles,
    or the whole sequence if it has fewer words. Two texts link when 100 x intersection >= ``percent`` x union
    (80 at least keeps parts selective; any value from 1 is right). ``component_id`` is the smallest doc_id reachable over links.
    A text without words, or a missing one, links with nothing. Rows with one id and different texts are different
    texts; a component whose ids are all missing has none. ``component`` is a number that tells components apart even
    so, and is missing where there are no words. Sets are compared by 64-bit shingle hashes.
    """
    return _Join(spark, documents, width, percent).run()


def digest(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return linked(spark, documents, width=3, percent=90).select("doc_id", "n_shingles", "component_id")


def one_of_each(spark: SparkSession, documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` less all but one row of each component: the row with the smallest doc_id stays.

    Rows without words stay, but for rows repeated with the same id and text. Texts of one id that do not link all stay;
    of linked ones the text with the smallest hash does. Columns pass through.
    """
    keep = linked(spark, documents, width, percent)
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("version"))
    grouped = keep.filter("component is not null").groupBy("component").agg(F.min(first).alias("first"))
    chosen = grouped.select(F.col("first.doc_id").alias("id"), F.col("first.version").alias("__of"))
    alone = keep.filter("component is null").select(F.col("doc_id").alias("id"), F.col("version").alias("__of"))
    chosen = chosen.union(alone).select(F.xxhash64("id", "__of").alias("__id"), "__of").distinct()
    keyed = _keyed(documents)
    on = (keyed["__row"] == chosen["__id"]) & (keyed["__version"] == chosen["__of"])
    kept = keyed.join(chosen.hint("merge"), on).dropDuplicates(["__row", "__version"])
    return kept.select(*(kept[c] for c in documents.columns))
