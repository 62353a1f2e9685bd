"""Embedding near-dedup against all pairs in double precision."""

import numpy as np
import pytest

from tidemark.llm import embedding_dedup as ed


def all_pairs(rows, threshold=0.95):
    good = [isinstance(v, list) and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(n):
        for y in range(x):
            if good[x] and good[y] and len(rows[x][1]) == len(rows[y][1]):
                a, b = (np.array(rows[k][1], dtype=float) / np.abs(rows[k][1]).max() for k in (x, y))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[x] += 1
                    links[y] += 1
                    root[find(x)] = find(y)
    groups = {}
    for x in range(n):
        groups.setdefault(find(x), []).append(rows[x][0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[x][0], links[x], least[find(x)], rows[x][0] == least[find(x)]) for x in range(n)), key=repr)


def found(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted((tuple(r) for r in ed.digest(spark, df).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def test_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ed, "SMALL_BLOCK", 40)
    random = np.random.default_rng(4)
    centres = random.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + random.normal(size=16) * random.choice([0.05, 0.2, 0.3])).astype(np.float32).tolist()) for i in range(260)]
    rows += [(300 + i, rows[i][1]) for i in range(5)] + [(400, [2 * x for x in rows[0][1]]), rows[3]]
    assert found(spark, rows) == all_pairs(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]),
            (9, [1.0]), (None, [1.0, 0.01]), (11, [1e38, 1e30]), (12, [1e-38, 0.0]), (12, [0.0, 1.0]), (-3, [1.0, 0.1, 0.0])]
    assert found(spark, rows) == all_pairs(rows)
    assert found(spark, []) == []


@pytest.mark.parametrize("dimensions", [1, 3, 64, 1500])
def test_no_link_hides_behind_the_quantisation(dimensions):
    random = np.random.default_rng(dimensions)
    left = ed.unit(random.normal(size=(60, dimensions)))
    right = ed.unit(np.concatenate([left[:40] + random.normal(size=(40, dimensions)) * 0.3 / np.sqrt(dimensions), left[40:]]))
    i, j = ed.strip_links(left, right, ed.quantised(left), ed.quantised(right), 0.95)
    a, b = np.nonzero(left @ right.T >= 0.95)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(a.tolist(), b.tolist()))
