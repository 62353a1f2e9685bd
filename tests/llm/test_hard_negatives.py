"""Hard negatives against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn


def brute_force(rows):
    kept = set()
    for id, vector, label in rows:
        if id is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if id % 7 == 0 else label
        kept.add((id, label, tuple(int(np.floor(256 * float(x))) for x in vector)))
    out = []
    for anchor in kept:
        if anchor[0] % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(anchor[2], row[2])), row) for row in kept if row != anchor]
        positives = sorted((s, row[0]) for s, row in scored if row[1] == anchor[1])[:5]
        for s, id in positives:
            low, high = 50 * -s, 95 * -s
            negatives = sorted((t, row[0]) for t, row in scored if row[1] != anchor[1] and low <= 100 * -t <= high)[:3]
            out += [(anchor[0], id, n, other, -s, -t) for n, (t, other) in enumerate(negatives, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted(tuple(r) for r in hn.digest(spark, df).select(*COLUMNS).collect())


def f32(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def clustered(n=400, width=8, seed=5):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(9, width))
    return f32([(i, (centres[i % 9] + random.normal(size=width) * 0.3).tolist(), int(random.integers(0, 10))) for i in range(n)])


def test_equals_all_products(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 60)
    monkeypatch.setattr(hn, "TILE_ROWS", 3)
    rows = clustered()
    # Equal vectors under many ids make ties; a repeated row counts once.
    rows += [(1000 + i, rows[3][1], i % 10) for i in range(60)] + [rows[5], rows[50]]
    assert found(spark, rows) == brute_force(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(50, None, 1), (100, [nan, 1.0], 1), (150, [inf, 1.0], 1), (200, [None, 1.0], 1), (None, [1.0, 1.0], 1), (250, [1.0, 1.0], None)]
    rows = [(300, [1.0, 0.5], 2), (301, [1.0, 0.25], 2), (302, [0.5, 0.25], 3), (303, [0.5, 0.25], 3), (304, [-1.0, 0.0], 2), (305, [0.0, 0.0], 4), (306, [], 5), (307, [0.75], 6), (302, [0.75, 0.0], 7), (350, [0.0, 0.0], 3)]
    assert found(spark, odd) == []
    assert found(spark, odd + rows) == brute_force(odd + rows) != []
    assert found(spark, []) == []


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(r, 1, "x", "y", 2) for r in clustered(120)], "r struct<vec_id:long,embedding:array<float>,label:int>, score int, version string, tile string, rank int")
    got = hn.digest(spark, rows.select("r.*", "score", "version", "tile", "rank")).select(*COLUMNS)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(clustered(120))


@pytest.mark.parametrize("width", [1, 3, 40])
def test_covering_radii_skip_nothing_that_counts(width):
    """Trees of several levels, windows at both ends, and queries longer and shorter than any candidate."""
    random = np.random.default_rng(width)
    centres = random.normal(size=(12, width)) * 300
    values = np.floor(centres[random.integers(0, 12, 700)] + random.normal(size=(700, width)) * random.choice([1, 20], (700, 1)))
    values[100:200] = values[0]
    ids, versions, labels = random.permutation(700), np.zeros(700, dtype=np.int64), random.integers(0, 4, 700)
    tree = hn.Tree.over(ids, versions, labels, values)
    for n in range(60):
        query = np.floor(values[n] * random.choice([0.1, 1, 5]) + random.normal(size=width))
        scores = (values @ query).astype(int)
        for same in (True, False):
            for low, high in ((-np.inf, np.inf), *(sorted(random.choice(scores, 2).tolist()) for _ in range(3))):
                best = hn._Best(3, low, high)
                hn.search(tree, query, 1, [best], same, (int(ids[n]), 0))
                rows = [(-s, i) for s, i, l in zip(scores, ids, labels) if (l == 1) == same and i != ids[n] and low <= s <= high]
                assert [(-s, i) for s, i, _ in best.rows] == sorted(rows)[:3]


def test_descent_leaves_nodes_closed(monkeypatch):
    """In a table of far groups most candidates are never multiplied."""
    random = np.random.default_rng(1)
    values = np.floor(np.repeat(random.normal(size=(40, 16)) * 2000, 50, axis=0) + random.normal(size=(2000, 16)) * 20)
    tree = hn.Tree.over(np.arange(2000), np.zeros(2000, dtype=np.int64), np.zeros(2000, dtype=np.int64), values)
    seen, plain = [], hn.products
    monkeypatch.setattr(hn, "products", lambda v, q, p: seen.append(len(v)) or plain(v, q, p))
    for n in range(0, 2000, 100):
        hn.search(tree, values[n], 0, [hn._Best(5)], True, (n, 0))
    assert sum(seen) < 20 * 2000 / 4


def test_products_beyond_doubles_are_exact():
    big = np.array([[2.0**40 + 1, 3.0], [2.0**40, -1.0]])
    assert hn.products(big, np.array([2.0**20 + 1, 1.0]), 2.0**40 + 1).tolist() == [(2**40 + 1) * (2**20 + 1) + 3, 2**40 * (2**20 + 1) - 1]


def test_plan_has_no_cross_join(spark):
    df = spark.createDataFrame(clustered(120), "vec_id long, embedding array<float>, label int")
    plan = hn.digest(spark, df.withColumn("x", F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nodes_of_a_tree_are_met_a_few_times_together(monkeypatch):
    """Random directions, of which hardly a node can be skipped: products are worked out in few calls, whatever the nodes."""
    rng = np.random.default_rng(5)
    values = np.floor(rng.normal(size=(2000, 32)) * 256)
    labels = np.arange(2000) % 10
    tree = hn.Tree.over(np.arange(2000), np.zeros(2000, dtype=np.int64), labels, values)
    calls, plain = [], hn.products
    monkeypatch.setattr(hn, "products", lambda v, q, p: calls.append(len(v)) or plain(v, q, p))
    for n in range(0, 2000, 100):
        best = hn._Best(5)
        hn.search(tree, values[n], int(labels[n]), [best], True, (n, 0))
        scores = values @ values[n]
        mine = [i for i in np.lexsort((np.arange(2000), -scores)) if i != n and labels[i] == labels[n]][:5]
        assert [r[1] for r in best.rows] == mine
    assert len(calls) <= 20 * 5
