"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import collocations as co

LOWER = {c: c + 32 for c in range(65, 91)}


def all_phrases(rows):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for i in range(len(words)):
                for j in range(i + 1, min(i + 5, len(words)) + 1):
                    counts[lang or "und"][tuple(words[i:j])] += 1
    return counts, totals


def brute_force(rows, least, first):
    counts, totals = all_phrases(rows)
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        found = []
        for p, a in often.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(q) for q, b in often.items()):
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(3)


def found(spark, rows, **options):
    return sorted(tuple(r) for r in co.collocations(spark, table(spark, rows), **options).collect())


def corpus(n=150, seed=1):
    r = random.Random(seed)
    words = ["the", "The", "of", "river", "stone", "née", "中文", "a|b", "x", "y"] + [f"w{i}" for i in range(30)]
    weights = [30, 10, 20, 5, 5, 3, 3, 2, 2, 2] + [1] * 30
    gaps = [" "] * 8 + ["  ", "\t", ", ", ".", "\n", "\r", "! ", "\x0b"]
    one = lambda: "".join(w + r.choice(gaps) for w in r.choices(words, weights, k=r.randint(0, 60)))
    rows = [(one() + r.choice(["", "the quick brown fox jumps over it", "of the river stone"]), r.choice(["en", "en", "de", None])) for _ in range(n)]
    return rows + [rows[0]] * 7 + [(None, "en"), ("", None), (" .;\n", "fr"), ("one", "fr"), ("the " * 400, "de"), ("q" * 3000 + " " + "x y " * 300, "en")]


@pytest.mark.parametrize("budget, listed", [(10**6, 1 << 18), (150, 1 << 18), (20, 1 << 18), (150, 12), (40, 3)])
def test_equals_all_phrases(spark, monkeypatch, budget, listed):
    """Whatever the groups: one for all, prefixes of up to five words, and words and prefixes that no table lists."""
    monkeypatch.setattr(co, "STRETCH", 300)
    monkeypatch.setattr(co, "AT_ONCE", 2000)
    rows = corpus()
    assert found(spark, rows, least=5, first=40, budget=budget, listed=listed) == brute_force(rows, 5, 40) != []


def test_ties_come_by_phrase(spark):
    rows = [(f"{a} {b}, " * 6, "en") for a, b in zip("zyxé", "abcd")]
    got = found(spark, rows, least=5, first=3)
    assert got == brute_force(rows, 5, 3) and [r[2] for r in got] == ["x c", "y b", "z a"]


def test_odd_rows(spark, odd, nothing):
    rows = [(r.text, r.lang) for r in odd.collect()]
    got = sorted(tuple(r) for r in co.collocations(spark, odd, least=3, first=25).collect())
    assert got == brute_force(rows, 3, 25) != []
    assert co.collocations(spark, nothing).collect() == []


def test_groups_keep_their_budget():
    """No group of listed prefixes holds more than twice the budget; a larger prefix is extended."""
    random_ = np.random.default_rng(1)
    counts = np.sort(random_.integers(1, 3000, 500))[::-1]
    grouping = co.Grouping()
    grouping.add(np.arange(500, dtype=np.uint64), counts, 0, 1000)
    groups = grouping.levels[0].of(np.arange(500, dtype=np.uint64))
    assert ((groups == -1) == (counts > 1000)).all()
    assert np.bincount(groups[groups >= 0], counts[groups >= 0]).max() <= 2000
    assert grouping.levels[0].of(np.array([999], dtype=np.uint64)).tolist() == [-2]


def test_blocks_come_back():
    random_ = np.random.default_rng(2)
    strange = np.unique(random_.integers(0, 2**63, 50).astype(np.uint64))
    windows = random_.integers(0, 100 + len(strange) + 1, (400, 5))
    counts = random_.integers(1, 10, 400)
    block = co.packed(windows, counts, 100, strange)
    names = np.concatenate([np.arange(101, dtype=np.uint64), strange])
    back, numbers, _ = co.merged([block, block], 100)
    assert len(back) == 800 and numbers.sum() == 2 * counts.sum()
    _, n, far = co.merged([block], 100)
    got = np.concatenate([np.arange(101, dtype=np.uint64), far])[co.merged([block], 100)[0]]
    assert sorted(zip(map(tuple, names[windows].tolist()), counts.tolist())) == sorted(zip(map(tuple, got.tolist()), n.tolist()))


def test_words_end_at_texts():
    texts = pa.array(["a b", None, "", "c, d e", "f"])
    _, rest, data, first, last = co.words_of(texts, "en")
    assert [bytes(data[a:b]).decode() for a, b in zip(first, last)] == list("abcdef")
    assert rest.tolist() == [2, 1, 1, 2, 1, 1]


def test_products_beyond_64_bits(spark):
    """Exact where 1000 * a * n and l * r leave 64 bits."""
    a, n, l, r = 90_000_000_000_007, 99_999_999_999_989, 99_999_999_999_971, 99_999_999_999_959
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long")
    assert row.select(co.score_of("a", "n", "l", "r")).first()[0] == 1000 * a * n // (l * r)
