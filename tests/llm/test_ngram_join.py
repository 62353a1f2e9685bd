"""The n-gram join against all pairs, near copies in numbers, and its sketch bounds."""

import random
import re

import numpy as np
import pytest

from tidemark.llm import ngram_join as nj
from tidemark.llm.words import shingles


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else frozenset()


def all_pairs(rows, width, percent):
    """(doc_id, size, smallest reachable id) by comparing every pair of sets."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(x)] = find(y)
    groups = {}
    for x, (i, s) in enumerate(sets):
        groups.setdefault(find(x) if s else -1 - x, []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((i, len(s), least[find(x) if s else -1 - x]) for x, (i, s) in enumerate(sets)), key=repr)


def found(spark, df, width, percent):
    return sorted((tuple(r) for r in nj.linked(spark, df, width, percent).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_equals_all_pairs_on_odd_rows(spark, odd, width, percent):
    assert found(spark, odd, width, percent) == all_pairs([(r.doc_id, r.text) for r in odd.collect()], width, percent)


def test_equals_all_pairs_among_near_copies(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    base = [r.choice(words) for _ in range(120)]
    rows = []
    for i in range(150):  # pairs lie around the threshold
        copy = list(base)
        for _ in range(r.randint(0, 6)):
            copy[r.randrange(len(copy))] = r.choice(words)
        rows.append((i, " ".join(copy[: len(copy) - r.randint(0, 8)])))
    rows += [(200 + i, " ".join(r.choice(words) for _ in range(r.randint(1, 60)))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width, percent in ((3, 90), (5, 80)):
        assert found(spark, df, width, percent) == all_pairs(rows, width, percent)


def test_one_of_each_keeps_one_row_of_a_group(spark, odd):
    kept = nj.one_of_each(spark, odd)
    assert kept.columns == odd.columns
    # By position, as an id can have several texts.
    expected = all_pairs(list(enumerate(r.text for r in odd.collect())), 5, 80)
    with_words = {c for _, n, c in expected if n}
    assert kept.filter("text rlike '[^ \\n\\t]'").count() == len(with_words)
    assert kept.filter("text is null").count() == 2


def test_an_empty_table(spark, nothing):
    assert nj.linked(spark, nothing).count() == 0 and nj.one_of_each(spark, nothing).count() == 0


@pytest.mark.parametrize("percent", [80, 90, 95])
def test_linked_sets_share_a_part_and_sketches_bound_their_difference(percent):
    random_numbers, bands = np.random.default_rng(1), nj.size_bands(percent)
    for size in [*range(1, 60), 100, 333, 1000, 4000]:
        common = random_numbers.integers(0, 2**64, size, dtype=np.uint64)
        for extra in range(0, 40, 3):
            a = np.unique(np.concatenate([common, random_numbers.integers(0, 2**64, extra // 2, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common, random_numbers.integers(0, 2**64, extra - extra // 2, dtype=np.uint64)]))
            differ = len(np.setxor1d(a, b))
            assert int(np.bitwise_count((nj.sketch(a) ^ nj.sketch(b)).view(np.uint64)).sum()) <= differ
            if differ and 100 * size >= percent * (len(a) + len(b) - size):
                assert set(nj.part_keys(a, percent, bands)) & set(nj.part_keys(b, percent, bands))


def test_shingles_of_few_words():
    words = np.arange(5, dtype=np.uint64)
    assert [len(shingles(words[:n], 3)) for n in range(6)] == [0, 1, 1, 1, 2, 3]


def test_a_hot_key_of_an_aggregate_join_is_split(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.skew import join_aggregate

    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000).select("id", F.expr("if(id % 5 < 4, -5, id)").alias("k"), F.sha2(F.expr("string(id)"), 256).alias("s"))
        joined = join_aggregate(rows, rows.groupBy("k").agg(F.min("id").alias("low")), "k")
        assert joined.columns == ["id", "k", "s", "low"] and joined.filter("k = -5 and low <> 0").count() == 0
        plan = joined.groupBy("low", "s").count()
        plan.collect()
        assert "skew=true" in plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_only_near_pairs_are_held_against_earlier_rounds(spark, monkeypatch):
    """The join that takes decided pairs out reads a table of near pairs, not the members of all parts."""
    plans, plain = {}, nj._Join.stored

    def stored(self, name, df):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(self, name, df)

    monkeypatch.setattr(nj._Join, "stored", stored)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:n] + [f"x{n}"] + words[n:]) for n in range(0, 60, 4)]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    nj.linked(spark, docs).collect()
    for name in ("links-1", "links-rest"):
        assert "LeftAnti" in plans[name] and "bit_count" not in plans[name]
        assert "bit_count" in plans[name.replace("links", "pairs")]


def test_wide_sketches_fold_and_bound_their_difference():
    random_numbers = np.random.default_rng(2)
    for size in (1, 512, 513, 1024, 1025, 5000):
        wide = nj.wide_sketch(random_numbers.integers(0, 2**64, size, dtype=np.uint64))
        assert len(wide) == 0 if size <= 512 else size <= 64 * len(wide) < 2 * size + 64
    a, b = (np.unique(random_numbers.integers(0, 2**64, n, dtype=np.uint64)) for n in (900, 1100))
    b = np.unique(np.concatenate([a, b[:190]]))
    folded = np.bitwise_xor.reduce(nj.wide_sketch(b).reshape(2, -1))
    assert (folded == nj.sketch(b, 16)).all() and len(nj.wide_sketch(a)) == 16
    assert int(np.bitwise_count((nj.wide_sketch(a) ^ folded).view(np.uint64)).sum()) <= len(np.setxor1d(a, b))


def test_texts_travel_for_near_pairs_alone(spark, monkeypatch):
    """Of large sets that share parts but not enough shingles, no text is fetched; keys and texts go after their use."""
    tables, plain = {}, nj._Join.stored

    def stored(self, name, df):
        out = tables[name] = plain(self, name, df)
        if name.startswith(("texts", "links")):
            tables[name] = out.count() if name.startswith("texts") else [r.linked for r in out.select("linked").collect()]
        return out

    monkeypatch.setattr(nj._Join, "stored", stored)
    r = random.Random(8)
    word = lambda: f"w{r.randrange(10**9)}"
    common = [word() for _ in range(1100)]
    # Jaccard of 0.6 but for the last two: one is a near copy across a fold (1,000 and 1,060 shingles), one of equal width.
    texts = [common + [word() for _ in range(370)] for _ in range(6)]
    texts += [common[:1004], common[:1004] + [word() for _ in range(60)], texts[0][:1450]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    join = nj._Join(spark, spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    result = sorted((x.doc_id, x.n_shingles, x.component_id) for x in join.run().collect())
    assert result == all_pairs(rows, 5, 80) and [x[2] for x in result] == [0, 1, 2, 3, 4, 5, 6, 6, 0]
    checked = [x for name, links in tables.items() if name.startswith("links") for x in links]
    assert sorted(checked) == [True, True]
    assert sum(n for name, n in tables.items() if name.startswith("texts")) == 4
    from tidemark.files import path_exists

    assert not any(path_exists(spark, f"{join.folder}/{name}") for name in ("rows/packed=true", "texts-0", "texts-1", "texts-rest"))


def test_pairs_whose_texts_exceed_the_table_are_checked_in_lots(spark, monkeypatch):
    rounds, plain = {}, nj._Join.stored

    def stored(self, name, df):
        out = plain(self, name, df)
        if name.startswith("links"):
            rounds[name] = [(x.a, x.b) for x in out.collect()]
        return out

    monkeypatch.setattr(nj._Join, "stored", stored)
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [r.choice(words) for _ in range(120)]
    copies = [[r.choice(words) if n == 4 * i else w for n, w in enumerate(base)] for i in range(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(copies)]
    found_here = found(spark, spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert found_here == all_pairs(rows, 5, 80)
    size = sum(len(t) for _, t in rows)
    assert "links-0-1" in rounds
    every = [p for pairs in rounds.values() for p in pairs]
    assert len(every) == len(set(every))
    # 2 x 120 words a pair: no lot takes much more than the table holds.
    assert max(len(p) for p in rounds.values()) * 2 * size / 30 < 1.6 * size
