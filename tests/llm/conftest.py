"""Small tables with the cases that every operator must survive."""

import random

import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, version string, `group` int"


def odd_rows():
    r = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "The", "river", "stone", "née", "ß", "42", "|", "中文"]
    body = lambda n: " ".join(r.choice(words) for _ in range(n))
    long = "\n".join(body(12) for _ in range(400))
    base = [body(90) for _ in range(6)]
    texts = [None, "", "  \n\t ", "one", "one two", long, long + " more", 'x password = "abcdefgh12345678" y', "é" * 3000, "a" * 20000]
    texts += base + base[:3] + [b.replace("river", "rivers", 1) for b in base] + ["l1 a\nl2 b\nl3 c\nl4 d", "zz\nl1 a\nl2 b\nl3 c\nq", "l1 a\n\nl2 b\nl3 c"]
    rows = [(i, t, ["en", "de", None][i % 3], f"src{i % 2}", 0, None, "v", i) for i, t in enumerate(texts)]
    rows += [rows[12], rows[12], (12, "another text of the same id", "en", None, 1, True, None, None), (None, base[0], None, None, None, None, None, None)]
    return [*rows, (None, None, None, None, None, None, None, None), (-7, base[1], "en", "src0", 5, False, "w", 9)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
