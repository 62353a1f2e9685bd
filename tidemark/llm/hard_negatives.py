"""Hard negatives by inner product, with cover trees over norm-augmented candidates.

A candidate x becomes (x, sqrt(M² - |x|²)), where M is the largest norm of its block; an anchor q becomes (q, 0). Then
|q - x|² = |q|² + M² - 2 q·x, so that a large inner product is a small distance. A node of a tree is a candidate with a
covering radius, the largest distance to anything below it, and the triangle inequality gives the least and the largest
inner product under the node. The ranges of all nodes of a tree are worked out at once; nodes are opened by falling upper
bound, a few and then more at a time, and those whose range of products lies outside every window that still wants
candidates are skipped. What is reached is compared by its exact integer product.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import workspace

ANCHOR_EVERY, SHIFT_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: Window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
#: Candidates of a block, about; each block has one tree, which one task builds.
BLOCK_ROWS = 2048
#: Blocks lie around so many sampled candidates at most; those of a crowded one are split by hash.
PIVOTS = 256
#: Anchors that meet a block in one task, about.
TILE_ROWS = 1024
LEAF, SHRINK = 64, 0.8
#: Nodes are opened so many times as many at a time as before, beginning with one.
GROWTH = 8
_EXACT = 2.0**52


@dataclass
class Node:
    """A subtree. ``members`` are rows compared as they are; ``children`` are subtrees with their own centres and radii.

    In a finished tree the members of a node lie side by side, from ``first`` to ``last``.
    """

    members: np.ndarray
    children: list["Node"] = field(default_factory=list)
    centres: np.ndarray | None = None  # row of each child's centre
    radii: np.ndarray | None = None
    label: int | None = None  # the one label below, if there is only one
    first: int = 0
    last: int = 0


def matrix(vectors: list[list[int]], width: int) -> np.ndarray:
    """Integers as doubles; missing trailing components are 0."""
    out = np.zeros((len(vectors), width))
    for n, v in enumerate(vectors):
        out[n, : len(v)] = v
    return out


@dataclass
class Tree:
    """The candidates of a block and the cover tree over them."""

    ids: np.ndarray
    versions: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    largest: float  # M²
    peak: float  # largest component
    nodes: "Nodes"

    @classmethod
    def over(cls, ids, versions, labels, values) -> "Tree":
        norms = np.einsum("ij,ij->i", values, values)
        largest = float(norms.max(initial=0.0))
        augmented = np.column_stack([values, np.sqrt(np.maximum(largest - norms, 0))])
        root = _grown(augmented, np.asarray(labels), np.arange(len(ids)), 0)
        order: list[np.ndarray] = []
        _laid(root, order, 0)
        rows = np.concatenate(order)
        place = np.empty_like(rows)
        place[rows] = np.arange(len(rows))
        _moved(root, place)
        return cls(ids[rows], versions[rows], labels[rows], values[rows], largest, float(np.abs(values).max(initial=0)), Nodes.of(root, values[rows]))


@dataclass
class Nodes:
    """The nodes of a finished tree in the order of a walk, the root first."""

    centres: np.ndarray  # vectors; the root has none and its range no end
    radii: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]  # per depth below the root: the nodes, and their parents
    mixed: np.ndarray  # more than one label below
    labels: np.ndarray  # the label below, where there is one
    filled: np.ndarray  # nodes with members
    owner: np.ndarray  # node of each row

    @classmethod
    def of(cls, root: Node, values: np.ndarray) -> "Nodes":
        found, stack = [], [(root, -1, 0, 0, np.inf)]
        while stack:
            node, parent, depth, centre, radius = stack.pop()
            stack += [(c, len(found), depth + 1, m, r) for c, m, r in zip(node.children, node.centres, node.radii)] if node.children else []
            found.append((parent, depth, centre, radius, node))
        parents, depths = np.array([f[0] for f in found]), np.array([f[1] for f in found])
        below = [np.flatnonzero(depths == d) for d in range(1, depths.max() + 1)]
        owner = np.zeros(len(values), dtype=np.int64)
        for n, f in enumerate(found):
            owner[f[4].first : f[4].last] = n
        label = [f[4].label for f in found]
        return cls(
            values[[f[2] for f in found]] if len(values) else np.zeros((len(found), values.shape[1])),
            np.array([f[3] for f in found], dtype=float),
            [(nodes, parents[nodes]) for nodes in below],
            np.array([x is None for x in label]),
            np.array([x or 0 for x in label], dtype=np.int64),
            np.array([f[4].last > f[4].first for f in found]),
            owner,
        )


def _laid(node: Node, order: list[np.ndarray], at: int) -> int:
    """Numbers the rows of a subtree in the order of a walk through it."""
    order.append(node.members)
    node.first, node.last = at, at + len(node.members)
    at = node.last
    for child in node.children:
        at = _laid(child, order, at)
    return at


def _moved(node: Node, place: np.ndarray) -> None:
    node.members = np.zeros(0, dtype=np.int64)
    if node.children:
        node.centres = place[node.centres]
        for child in node.children:
            _moved(child, place)


def _grown(points: np.ndarray, labels: np.ndarray, rows: np.ndarray, centre: int) -> Node:
    """Subtree of ``rows``, whose centre is ``rows[centre]``.

    Children are separated centres: the farthest row becomes the next one until all lie within the level's radius. A
    level whose radius separates all rows has them as members.
    """
    own = np.unique(labels[rows]) if len(rows) else np.zeros(0)
    label = int(own[0]) if len(own) == 1 else None
    if len(rows) <= LEAF:
        return Node(rows, label=label)
    distance = np.linalg.norm(points[rows] - points[rows[centre]], axis=1)
    radius = float(distance.max()) * SHRINK
    if radius == 0:
        return Node(rows, label=label)
    chosen, nearest = [centre], np.zeros(len(rows), dtype=np.int64)
    while True:
        far = int(distance.argmax())
        if distance[far] <= radius:
            break
        if len(chosen) * 2 > len(rows):
            return Node(rows, label=label)
        away = np.linalg.norm(points[rows] - points[rows[far]], axis=1)
        closer = away < distance
        nearest[closer], distance = len(chosen), np.minimum(away, distance)
        chosen.append(far)
    node = Node(np.zeros(0, dtype=np.int64), label=label)
    single, centres, radii = [], [], []
    for k, c in enumerate(chosen):
        mine = np.flatnonzero(nearest == k)
        if len(mine) <= 2:
            single.append(rows[mine])
            continue
        node.children.append(_grown(points, labels, rows[mine], int(np.flatnonzero(mine == c)[0])))
        centres.append(rows[c])
        radii.append(float(distance[mine].max()))
    node.members = np.concatenate(single) if single else node.members
    node.centres, node.radii = np.array(centres, dtype=np.int64), np.array(radii)
    return node


def products(values: np.ndarray, query: np.ndarray, peak: float) -> np.ndarray:
    """Exact inner products with components up to ``peak``: in doubles where all sums are exact there, else in whole
    numbers without a limit."""
    if peak * np.abs(query).max(initial=0) * max(1, len(query)) < _EXACT:
        return values @ query
    whole = [int(x) for x in query]
    return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in values], dtype=object)


class _Best:
    """The ``size`` best of one window of scores: higher scores first, then smaller ids, then smaller versions."""

    def __init__(self, size: int, low: float = -np.inf, high: float = np.inf):
        self.size, self.low, self.high, self.rows = size, low, high, []

    @property
    def least(self):
        """The least score that can still enter."""
        return max(self.low, self.rows[-1][0]) if len(self.rows) == self.size else self.low


def _offer(windows: list[_Best], scores: np.ndarray, wanted: np.ndarray, ids: np.ndarray, versions: np.ndarray, key: tuple[int, int]) -> None:
    """Shows the wanted rows to every window; they are ordered once for all."""
    at = np.flatnonzero(wanted & (scores >= min(w.least for w in windows)) & (scores <= max(w.high for w in windows)))
    if not len(at):
        return
    rows = sorted(r for r in zip((-scores[at]).tolist(), ids[at].tolist(), versions[at].tolist()) if r[1:] != key)
    falling = [r[0] for r in rows]
    for w in windows:
        start, least = bisect_left(falling, -w.high), w.least
        new = [(-s, i, v) for s, i, v in rows[start : start + w.size] if -s >= least]
        if new:
            w.rows = sorted([*w.rows, *new], key=lambda r: (-r[0], r[1], r[2]))[: w.size]


def search(tree: Tree, query: np.ndarray, label: int, windows: list[_Best], same: bool, key: tuple[int, int]) -> None:
    """Offers every candidate of the tree that can enter a window: those of the label, or those of other labels.

    ``key`` (id and version) is the anchor's own, which is never offered.
    """
    total, nodes = float(query @ query) + tree.largest, tree.nodes
    slack = 1e-9 * (total + 1)
    distance, reach = np.sqrt(np.maximum(total - 2 * (nodes.centres @ query), 0)), nodes.radii * (1 + 1e-9)
    upper = (total - np.maximum(distance - reach, 0) ** 2) / 2 + slack
    lower = (total - (distance + reach) ** 2) / 2 - slack
    upper[0], lower[0] = np.inf, -np.inf
    for own, parents in nodes.levels:
        upper[own], lower[own] = np.minimum(upper[own], upper[parents]), np.maximum(lower[own], lower[parents])
    waiting = np.flatnonzero(nodes.filled & (nodes.mixed | ((nodes.labels == label) == same)))
    waiting = waiting[np.argsort(-upper[waiting], kind="stable")]
    fitting = (tree.labels == label) == same
    together = 1
    while len(waiting):
        least, most = min(w.least for w in windows), max(w.high for w in windows)
        waiting = waiting[(upper[waiting] >= least) & (lower[waiting] <= most)]
        opened = np.zeros(len(upper), dtype=bool)
        opened[waiting[:together]] = True
        waiting, together = waiting[together:], together * GROWTH
        rows = np.flatnonzero(opened[nodes.owner] & fitting)
        if len(rows):
            scores = products(tree.values[rows], query, tree.peak)
            _offer(windows, scores, np.ones(len(rows), dtype=bool), tree.ids[rows], tree.versions[rows], key)


def prepared(embeddings: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, version (of label and vector), label and values of every row that takes part, each once.

    Rows without an id, a label or a vector, or with a missing or non-finite component, take no part; a row that is
    repeated as it is counts once. Rows of one id with other content are rows of their own, ordered by version.
    """
    values = F.col(vector).cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.filter(F.col(id).isNotNull() & F.col(label).isNotNull() & F.coalesce(sound, F.lit(False)))
    rows = rows.select(F.col(id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.transform(values, lambda x: F.floor(x * 256)).alias("values"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label")))
    return rows.distinct().withColumn("version", F.xxhash64("label", "values"))


def _near(pivots: np.ndarray):
    """Adds the nearest pivot of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = np.einsum("ij,ij->i", pivots, pivots)
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                values = batch.column("values").to_pylist()
                width = max([pivots.shape[1], *map(len, values)])
                wide = np.zeros((len(pivots), width))
                wide[:, : pivots.shape[1]] = pivots
                nearest = (norms - 2 * (matrix(values, width) @ wide.T)).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.astype(np.int32))], names=[*batch.schema.names, "pivot"])

    return run


def _planted(key: tuple, table: pa.Table) -> pa.Table:
    values = table.column("values").to_pylist()
    tree = Tree.over(
        table.column("vec_id").to_numpy(), table.column("version").to_numpy(), table.column("label").to_numpy(),
        matrix(values, max(map(len, values), default=0)),
    )
    return pa.table({"block": [key[0].as_py()], "tree": pa.array([pickle.dumps(tree)], pa.binary())})


def _met(same: bool):
    """One tree and one tile of anchors: per anchor the best of its label, or the best of other labels for each window."""

    def run(trees: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if trees.num_rows and anchors.num_rows:
            tree: Tree = pickle.loads(trees.column("tree")[0].as_py())
            width = tree.values.shape[1]
            vectors = anchors.column("values").combine_chunks()
            flat, ends = vectors.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum([0, *vectors.value_lengths().to_pylist()])
            for n, a in enumerate(anchors.drop_columns("values").to_pylist()):
                query = np.zeros(width)
                own = flat[ends[n] : ends[n + 1]][:width]
                query[: len(own)] = own
                key = (a["vec_id"], a["version"])
                wanted = [None] if same else a["positives"]
                windows = [_Best(POSITIVES) if w is None else _Best(NEGATIVES, *_window(w["score"])) for w in wanted]
                search(tree, query, a["label"], windows, same, key)
                for w, best in zip(wanted, windows):
                    out += [(*key, *((None, None, None) if w is None else (w["id"], w["version"], w["score"])), int(i), int(v), int(s)) for s, i, v in best.rows]
        columns = list(zip(*out)) if out else [()] * len(FOUND)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=FOUND)

    return run


FOUND = ["vec_id", "version", "positive_id", "positive_version", "positive_score", "id", "other_version", "score"]


def _window(score: int) -> tuple[int, int]:
    """The least and the largest score s with LOW * score <= 100 * s <= HIGH * score."""
    return -(-LOW * score // 100), HIGH * score // 100


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "other_version")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mined(spark: SparkSession, rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (of ``prepared``).

    One row per anchor, positive and rank: anchor_id, anchor_version, positive_id, rank, negative_id, positive_score,
    negative_score. Candidates lie in blocks around sampled ones, a tree each; anchors meet every tree in tiles, once for
    their positives and once for the windows that these open. No block or tile grows with the table, whatever its
    labels; all candidates take part. Vectors of different lengths are compared as if the shorter one ended in zeros.
    Equal scores come by id, then version. Products beyond 64 bits fail. An empty table gives no row.
    """
    folder = workspace(spark, "hard-negatives")
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    count = rows.count()
    wanted = min(PIVOTS, max(1, -(-count // BLOCK_ROWS)))
    sample = [r["values"] for r in rows.orderBy(F.xxhash64("vec_id", "version"), "vec_id", "version").limit(wanted).collect()]
    pivots = matrix(sample, max(map(len, sample), default=0)) if sample else np.zeros((1, 0))
    near = rows.mapInArrow(_near(pivots), "vec_id long, label long, `values` array<long>, version long, pivot int")
    near.write.parquet(f"{folder}/near")
    near = spark.read.parquet(f"{folder}/near")
    # At most PIVOTS sizes; a crowded pivot gets several blocks.
    sizes = {r["pivot"]: r["rows"] for r in near.groupBy("pivot").agg(F.count("*").alias("rows")).collect()}
    splits = [-(-sizes.get(p, 0) // BLOCK_ROWS) for p in range(len(pivots))]
    starts = [sum(splits[:p]) for p in range(len(splits))]
    blocks = max(1, sum(splits))
    part = F.pmod(F.xxhash64("vec_id", "version", F.lit(5)), F.element_at(F.array(*map(F.lit, [max(1, s) for s in splits])), F.col("pivot") + 1))
    start = F.element_at(F.array(*map(F.lit, starts)), F.col("pivot") + 1)
    near.withColumn("block", (start + part).cast("long")).groupBy("block").applyInArrow(_planted, "block long, tree binary").write.parquet(f"{folder}/trees")
    trees = spark.read.parquet(f"{folder}/trees")
    anchors = rows.filter(is_anchor)
    tiles = max(1, -(-anchors.count() // TILE_ROWS))
    anchors = anchors.withColumn("tile", F.pmod(F.xxhash64("vec_id", "version", F.lit(9)), F.lit(tiles)))
    every = trees.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    schema = ", ".join(f"{c} long" for c in FOUND)

    def meet(asking: DataFrame, same: bool) -> DataFrame:
        asked = asking.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return every.groupBy("block", "tile").cogroup(asked.groupBy("block", "tile")).applyInArrow(_met(same), schema)

    best = _first(meet(anchors, True), ["vec_id", "version"], POSITIVES)
    asked = best.groupBy("vec_id", "version").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("id"), F.col("other_version").alias("version"), "score"))).alias("positives")
    )
    anchors.join(asked, ["vec_id", "version"]).write.parquet(f"{folder}/asked")
    found = meet(spark.read.parquet(f"{folder}/asked"), False)
    found = _first(found, ["vec_id", "version", "positive_id", "positive_version"], NEGATIVES)
    return found.select(
        F.col("vec_id").alias("anchor_id"), F.col("version").alias("anchor_version"), "positive_id", "rank",
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def digest(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """Every fiftieth id is an anchor."""
    found = mined(spark, prepared(embeddings.select("vec_id", "embedding", "label")), F.col("vec_id") % ANCHOR_EVERY == 0)
    return found.drop("anchor_version")


ORACLE = """
WITH rows AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER w)::INTEGER AS rank, n.id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
QUALIFY row_number() OVER w <= 3
"""
