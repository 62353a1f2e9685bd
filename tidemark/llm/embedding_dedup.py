"""Embedding near-dedup by int8 tiles.

Unit vectors are quantised to int8 with one scale each. If e and f are the norms of the errors, the true cosine differs
from the quantised product by e + (1 + e) f at most, so that the tile product decides nearly all pairs; those that could
be on either side are computed again in double precision.

Equal vectors are one node with a weight. Nodes are dealt to blocks by a hash, and each pair of blocks is one task,
whatever near copies a block holds. A block is bounded in rows and in bytes. A task emits no pairs: it counts the links of each of its vectors and gives every
linked one a representative. All pairs of different vectors are looked at, as no cheaper bound holds for arbitrary
directions; the tile grows with the table up to a fixed size, which keeps the copies that are shuffled few.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.skew import join_aggregate
from tidemark.session import workspace

THRESHOLD = 0.95
BLOCKS, SMALL_BLOCK, LARGE_BLOCK = 12, 256, 65_536
#: Bytes of a block's vectors in double precision, at most; a task holds a few copies of two blocks.
BLOCK_BYTES = 64_000_000
STRIP = 256


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled first by the largest component, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, and norms of the errors, with a margin for the arithmetic of the bound itself."""
    scale = np.abs(units).max(axis=1) / 127
    values = np.rint(units / scale[:, None])
    error = np.sqrt(((units - values * scale[:, None]) ** 2).sum(axis=1)) + 1e-6
    return values.astype(np.int8), scale, error


def strip_links(left: np.ndarray, right: np.ndarray, a: tuple, b: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of unit vectors whose cosine is ``threshold`` at least; a and b are the quantised sides."""
    (values, s, e), (others, t, f) = a, b
    # Sums of products of int8 values are whole numbers that single precision holds up to 1,040 dimensions.
    exact = np.float32 if left.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = values.astype(exact) @ others.astype(exact).T
    product *= t.astype(exact)[None, :]
    # The margin of quantised() covers the rounding of the scaled product in single precision.
    slack = e + (1 + e) * f.max(initial=0)
    i, j = np.nonzero(product >= ((threshold - slack) / s).astype(exact)[:, None])
    cosine = product[i, j] * s[i]
    tight = e[i] + (1 + e[i]) * f[j]
    kept = cosine >= threshold + tight
    doubtful = np.flatnonzero(~kept & (cosine >= threshold - tight))
    for at in range(0, len(doubtful), 1 << 15):
        d = doubtful[at : at + (1 << 15)]
        kept[d] = (left[i[d]] * right[j[d]]).sum(axis=1) >= threshold
    return i[kept], j[kept]


def block_pair(left: np.ndarray, right: np.ndarray, weights: tuple[np.ndarray, np.ndarray], same: bool, threshold: float):
    """Weight of the links of each vector (left ones, then right ones) and a representative that all linked ones share."""
    n, m = len(left), len(right)
    counts, root = np.zeros(n + m, dtype=np.int64), np.arange(n + m)
    if same:
        root[n:] = np.arange(n)
    right_q = quantised(right) if m else None
    for at in range(0, n if m else 0, STRIP):
        part = left[at : at + STRIP]
        i, j = strip_links(part, right, quantised(part), right_q, threshold)
        i += at
        if same:
            i, j = i[i != j], j[i != j]
        counts[:n] += np.bincount(i, weights=weights[1][j], minlength=n).astype(np.int64)
        if not same:
            counts[n:] += np.bincount(j, weights=weights[0][i], minlength=m).astype(np.int64)
        rows, starts = np.unique(i, return_index=True)
        for row, partners in zip(rows, np.split(j, starts[1:])):
            around = np.unique(np.append(root[n + partners], root[row]))
            if len(around) > 1:
                root[np.isin(root, around)] = around[0]
    return counts, root


def _paired(threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        i, j = (k.as_py() for k in key[:2])
        block = table.column("block").to_numpy()
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        vectors = unit(flat.reshape(len(node), -1)) if len(node) else np.zeros((0, 1))
        a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
        counts, root = block_pair(vectors[a], vectors[b], (weight[a], weight[b]), i == j, threshold)
        # Representatives are positions within the pair; the block on itself counts each vector once.
        nodes = node[a] if i == j else np.concatenate([node[a], node[b]])
        own = np.arange(len(nodes))
        named = np.concatenate([node[a], node[b]])[root[: len(nodes)]]
        hit = counts[own] > 0
        return pa.table({"node": nodes[hit], "links": counts[own][hit], "other": named[hit]})

    return run


def block_rows(width: int) -> int:
    """Vectors of a block, by their length."""
    return max(1, min(LARGE_BLOCK, BLOCK_BYTES // (8 * max(1, width))))


def linked(spark: SparkSession, embeddings: DataFrame, threshold: float = THRESHOLD, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``embeddings`` with n_links, component_id and kept.

    Vectors that are missing, empty or zero, or hold missing or non-finite components, link with nothing, nor do vectors
    of different lengths. ``n_links`` counts other rows; equal vectors link with each other. ``component_id`` is the
    smallest id reachable over links; ``kept`` says whether it is the row's own. Rows without an id have links, too.
    Columns of these names are replaced; an empty table gives no row.
    """
    folder = workspace(spark, "embedding-dedup")
    values = F.col(vector).cast("array<double>")
    sound = F.coalesce(
        F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0), F.lit(False)
    )
    rows = embeddings.drop("n_links", "component_id", "kept")
    keyed = rows.withColumn("__sound", sound).withColumn("__a", F.xxhash64(vector)).withColumn("__b", F.xxhash64(F.lit(7), vector))
    classes = keyed.filter("__sound").groupBy("__a", "__b").agg(F.count("*").alias("weight"), F.min(id).alias("least"), F.first(vector).alias("vector"))
    classes.withColumn("node", F.monotonically_increasing_id()).write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    count, width = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    blocks = max(1, min(BLOCKS, count // SMALL_BLOCK), -(-count // block_rows(width)))
    dealt = nodes.select("node", "weight", "vector", F.size("vector").alias("size"), F.pmod(F.xxhash64("__a", "__b", F.lit(11)), F.lit(blocks)).cast("int").alias("block"))
    others = F.sequence(F.lit(0), F.lit(blocks - 1))
    met = dealt.withColumn("with", F.explode(others))
    met = met.withColumn("i", F.least("block", "with")).withColumn("j", F.greatest("block", "with")).drop("with")
    # Both blocks of a pair, and vectors of one length.
    found = met.groupBy("i", "j", "size").applyInArrow(_paired(threshold), "node long, links long, other long")
    found.write.parquet(f"{folder}/links")
    found = spark.read.parquet(f"{folder}/links")
    edges = found.filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    named = nodes.select("__a", "__b", "node", "weight", "least").join(components(edges, f"{folder}/components"), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = join_aggregate(named, least, "component").join(counts.hint("merge"), "node", "left")
    named = named.select("__a", "__b", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    named.write.parquet(f"{folder}/named")
    named = spark.read.parquet(f"{folder}/named")
    good = keyed.filter("__sound").join(named.hint("merge"), ["__a", "__b"])
    bad = keyed.filter("not __sound").withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col(id))
    both = good.select(*rows.columns, "n_links", "component_id").union(bad.select(*rows.columns, "n_links", "component_id"))
    return both.withColumn("kept", F.col(id).eqNullSafe(F.col("component_id")))


def digest(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    return linked(spark, embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")).drop("embedding")


ORACLE = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n FROM embeddings
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95
), reach(a, b) AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(l.b, v.vec_id)) AS kept
FROM v LEFT JOIN counts c ON c.a = v.vec_id LEFT JOIN least l ON l.a = v.vec_id
"""
