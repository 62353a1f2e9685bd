"""The quality classifier: measures against a plain count, tables against trees, held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality_gam as qg


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    return (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_measures_of_a_text():
    texts = ["one two two, THREE!\n\none two two, THREE!\nx1 é", "", None, "   \n ", "a" * 50]
    got = {t: dict(zip(qg.MEASURES, row)) for t, row in zip(texts, qg.measures(pa.array(texts)))}
    row, words = got[texts[0]], texts[0].split()
    size = len(texts[0].encode())
    assert row["words"] == pytest.approx(np.log1p(len(words)))
    assert row["word_length"] == pytest.approx(np.mean([len(w.encode()) for w in words]))
    assert row["upper"] == pytest.approx(10 / sum(c.isascii() and c.isalpha() for c in texts[0]))
    assert row["shouts"] == pytest.approx(2 / size) and row["marks"] == pytest.approx(2 / size)
    assert row["repeated_lines"] == pytest.approx(1 - 2 / 3) and row["distinct_words"] == pytest.approx(len(set(words)) / len(words))
    assert row["top_word"] == pytest.approx(2 / len(words))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    assert row["repeated_windows"] == pytest.approx(1 - len(set(windows)) / len(windows))
    assert row["lettered_words"] == pytest.approx(sum(w.isalpha() for w in words) / len(words))
    assert not any(got[""].values()) and not any(got[None].values())
    assert got[texts[3]]["spaces"] == 1 and got[texts[3]]["words"] == 0


def test_batches_do_not_matter():
    texts = ["One two\nthree", "", "The The The", "x" * 3000 + " y", None, "né à\tb! ! !"]
    assert np.allclose(qg.measures(pa.array(texts)), np.concatenate([qg.measures(pa.array([t], pa.string())) for t in texts]))


def test_a_shallow_tree_cuts_best():
    random = np.random.default_rng(2)
    slope, curve = random.normal(size=12), random.random(12) + 0.1
    value = lambda a, b: slope[a:b].sum() ** 2 / (curve[a:b].sum() + qg.RIDGE)
    best = max(range(1, 12), key=lambda k: value(0, k) + value(k, 12))
    step = qg.shallow_tree(slope, curve, depth=1)
    assert np.allclose(step[:best], slope[:best].sum() / (curve[:best].sum() + qg.RIDGE))
    assert np.allclose(step[best:], slope[best:].sum() / (curve[best:].sum() + qg.RIDGE))
    assert len(set(qg.shallow_tree(slope, curve).tolist())) <= 4


def test_a_crossed_tree_cuts_best():
    random = np.random.default_rng(3)
    slope, curve = random.normal(size=(5, 4)), random.random((5, 4)) + 0.1
    value = lambda s, c: s.sum() ** 2 / (c.sum() + qg.RIDGE)
    quarters = lambda x, i, j: (x[: i + 1, : j + 1], x[: i + 1, j + 1 :], x[i + 1 :, : j + 1], x[i + 1 :, j + 1 :])
    sums = {(i, j): sum(value(s, c) for s, c in zip(quarters(slope, i, j), quarters(curve, i, j))) for i in range(5) for j in range(4)}
    gain, step = qg.crossed_tree(slope, curve)
    assert gain == pytest.approx(max(sums.values()) - value(slope, curve))
    i, j = max(sums, key=sums.get)
    assert step[0, 0] == pytest.approx(slope[: i + 1, : j + 1].sum() / (curve[: i + 1, : j + 1].sum() + qg.RIDGE))


def test_pairs_find_what_single_tables_cannot():
    """A label that is the parity of two measures has no main effect at all."""
    random = np.random.default_rng(4)
    x = random.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = qg.fit(x[:2000], y[:2000])
    assert (2, 0) in model.pairs
    assert auc(y[2000:], model.scores(x[2000:])) > 0.97
    model.pairs, model.grids = [], []
    assert auc(y[2000:], model.scores(x[2000:])) < 0.7


def test_scores_are_sums_of_tables():
    random = np.random.default_rng(5)
    x = random.random((400, 3))
    model = qg.fit(x, (x[:, 0] + x[:, 1] > 1).astype(float))
    for row, logit in zip(x[:30], model.logits(x[:30])):
        bins = [int((e <= v).sum()) for e, v in zip(model.edges, row)]
        coarse = [int((e <= v).sum()) for e, v in zip(model.coarse, row)]
        want = model.offset + sum(t[b] for t, b in zip(model.tables, bins)) + sum(g[coarse[f], coarse[h]] for (f, h), g in zip(model.pairs, model.grids))
        assert logit == pytest.approx(want)


def test_few_labels():
    assert qg.fit(np.zeros((0, 3)), np.zeros(0)).scores(np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert qg.fit(np.zeros((20, 3)), np.ones(20)).scores(np.zeros((1, 3)))[0] == pytest.approx(21 / 22)


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(i, i % 2, 7) for i in range(20)] + [(3, 0, 7), (None, 1, 7), (4, None, 7), (5, 9, 7)], "doc_id long, quality int, score int")
    got = qg.digest(odd, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert qg.digest(nothing, labels).collect() == []
    assert {r.score for r in qg.digest(odd, labels.limit(0)).collect()} == {0.5}


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = qg.digest(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    y, s = rows["quality"].to_numpy(), rows["score"].to_numpy()
    assert len(rows) > 1000
    assert auc(y, s) >= 0.97
    # Both kinds are found: a constant answer has a balanced accuracy of 0.5.
    assert ((s >= 0.5)[y == 1].mean() + (s < 0.5)[y == 0].mean()) / 2 >= 0.9


def test_held_out_labels_change_nothing(spark, small):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    other = labels.withColumn("quality", qg.F.when(qg.held_out(), 1 - qg.F.col("quality")).otherwise(qg.F.col("quality")))
    scores = [sorted((r.doc_id, r.score) for r in qg.digest(small, found).collect()) for found in (labels, other)]
    assert scores[0] == scores[1]
