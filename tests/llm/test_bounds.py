"""Bounds that hold at sizes which the small tables do not reach."""

import random
import subprocess
import sys
import time

import numpy as np
import pytest

from tidemark.llm import embedding_dedup, language_id, pieces, token_counts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def test_long_runs_of_spaces_take_no_square_of_steps():
    import sentencepiece

    model, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.pieces(MODEL)
    for n in (3, 65, 66, 200, 4000):
        text = "a" + " " * n + "b"
        assert own.encode([text])[0].tolist() == model.encode(text)
    start = time.time()
    ids = own.encode([" " * 500_000 + "x"])[0]
    assert time.time() - start < 10
    assert pieces.decode(ids.tolist(), pieces.raw_pieces(MODEL)) == " " * 500_000 + "x"


def test_merging_with_a_heap_equals_plain_merging(monkeypatch):
    own, r = pieces.pieces(MODEL), random.Random(3)
    texts = ["".join(r.choice(["▁", "▁▁", "the", "river", "a", "é", "中", "ing", "x"]) for _ in range(r.randint(1, 60))) for _ in range(300)]
    plain = [own.merged(t) if len(t) <= pieces.LONG else None for t in texts]
    long = [own.merged_long(t) for t in texts]
    assert all(p is None or p == q for p, q in zip(plain, long))
    monkeypatch.setattr(pieces, "LONG", 10**9)
    assert [own.merged(t) for t in texts] == long


def test_remembered_pairs_are_bounded(monkeypatch):
    own = pieces.Pieces(MODEL)
    monkeypatch.setattr(pieces, "PAIRS", 500)
    r = random.Random(4)
    texts = [" ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(80)) for _ in range(60)]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in texts:
        assert own.encode([text])[0].tolist() == model.encode(text)
    assert len(own.pair_keys) < 5000 and (np.diff(own.pair_keys) > 0).all()


def test_blocks_of_long_vectors_are_smaller():
    assert embedding_dedup.block_rows(64) == embedding_dedup.LARGE_BLOCK
    assert embedding_dedup.block_rows(1024) * 1024 * 8 <= embedding_dedup.BLOCK_BYTES
    assert embedding_dedup.block_rows(10**9) == 1


def test_long_vectors_are_compared_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 40 * 1024 * 8)
    numbers = np.random.default_rng(2)
    rows = [(i, numbers.normal(size=1024).astype(np.float32).tolist()) for i in range(90)]
    rows += [(100 + i, [x + 1e-3 for x in rows[i][1]]) for i in range(10)]
    found = embedding_dedup.digest(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r.vec_id: r.component_id for r in found if r.n_links} == {k: i for i in range(10) for k in (i, 100 + i)}


LANGUAGES = """
import random, resource, sys
sys.path.insert(0, {root!r})
from tidemark.llm import language_id
r = random.Random(1)
texts, labels = [], []
for n in range(200):
    letters = [chr(0x4E00 + 30 * n + k) for k in range(30)]
    for _ in range(language_id.TEXTS // 200):
        texts.append("".join(r.choice(letters) for _ in range(400)))
        labels.append(f"l{{n}}")
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
model = language_id.fit(texts, labels)
assert model.predict([language_id.code_points(texts[0])])[0] == ["l0"]
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_two_hundred_languages_fit_into_a_gigabyte():
    root = str(__import__("pathlib").Path(__file__).resolve().parents[2])
    out = subprocess.run([sys.executable, "-c", LANGUAGES.format(root=root)], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.split()[-1]) < 1000


def test_equal_cosines_go_to_the_language_that_comes_first():
    texts = ["abc abc abc", "abc abc abc"]
    for labels in (["x", "b"], ["b", "x"]):
        assert language_id.fit(texts, labels).predict([language_id.code_points("abc abc")])[0] == ["b"]


def test_a_large_file_is_read_in_ranges_by_several_tasks(spark, tmp_path):
    numbers = np.random.default_rng(3)
    ids = numbers.integers(0, 100, 200_000).astype("<u2")
    ids[ids == 5] = token_counts.END
    (tmp_path / "one.bin").write_bytes(ids.tobytes() + b"x")  # an odd byte at the end is no id
    (tmp_path / "none.bin").write_bytes(b"")
    blocks = token_counts.blocks_of(spark, f"{tmp_path}/*.bin", 1000, range_blocks=8)
    rows = blocks.selectExpr("file", "block", "ids", "spark_partition_id() task").collect()
    assert sorted(r.block for r in rows) == list(range(200)) and len({r.task for r in rows}) > 1
    assert b"".join(bytes(r.ids) for r in sorted(rows, key=lambda r: r.block)) == ids.tobytes()
    found = token_counts.counted(token_counts.blocks_of(spark, f"{tmp_path}/*.bin", 1000, range_blocks=8), f"{tmp_path}/out").collect()
    assert sum(r.n_tokens for r in found) == (ids != token_counts.END).sum()


def test_ids_that_do_not_fit_are_an_error(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\nYg== 70000\n")
    with pytest.raises(ValueError, match="65535"):
        token_counts._encoding(str(tmp_path / "ranks"))


def test_forgotten_stretches_and_crowded_places_change_no_ids(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(pieces, "REMEMBERED", 60)
    monkeypatch.setattr(pieces, "PLACES", 64)
    own, r = pieces.Pieces(MODEL), random.Random(5)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 8))) for _ in range(120)]
    for _ in range(40):
        text = " ".join(r.choices(words, k=25))
        assert own.encode([text])[0].tolist() == model.encode(text)
        assert len(own.known) <= 30 and len(own.older) <= 30
