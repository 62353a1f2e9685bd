"""Language ID by nearest centroid.

A text is a TF-IDF vector of hashed letter n-grams (1 to 3). Every language has several centroids, found by spherical
k-means, and the language of the centroid with the largest cosine wins. A text whose cosine is far below what texts
of its length reach is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.fitting import fitted

BUCKETS = 1 << 13
CENTROIDS = 4
#: Labelled texts of each language that a model is fitted on, at most; languages that are learned, the most frequent first.
SAMPLE = 300
LANGUAGES = 1000
#: Texts that a model is fitted on, at most, over all languages; letters of each that count for it.
TEXTS, LETTERS = 6000, 1 << 16
ROWS_AT_ONCE = 256
#: A text is rejected below this share of the cosine that 99 of 100 texts of its length reach.
TOLERANCE = 0.5
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def code_points(text: str) -> np.ndarray:
    """Lower-case letters of the whole text, every run of others as one space; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, points, 32)[keep]


def gram_counts(points: np.ndarray) -> np.ndarray:
    """How often each hashed n-gram occurs."""
    x = points.astype(np.uint64) + np.uint64(1)
    grams = [x]
    for _ in range(2):
        if len(grams[-1]) > 1:
            grams.append(grams[-1][:-1] * np.uint64(0x110003) + x[len(grams) :])
    hashed = [((g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(51)).astype(np.int64) for g in grams]
    return np.bincount(np.concatenate(hashed), minlength=BUCKETS)


def length_class(points: int) -> int:
    return min(16, max(0, points - 1).bit_length())


@dataclass
class Model:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    centroids: np.ndarray
    floors: np.ndarray  # least cosine by length class

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        weighted = np.log1p(counts).astype(np.float32) * self.idf
        norm = np.sqrt((weighted * weighted).sum(axis=1, keepdims=True))
        return weighted / np.where(norm > 0, norm, 1)

    def predict(self, points: list[np.ndarray]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is rejected, of each text."""
        counts = np.stack([gram_counts(p) if len(p) else np.zeros(BUCKETS, np.int64) for p in points])
        cosines = self.vectors(counts) @ self.centroids.T if self.languages else np.zeros((len(points), 1), np.float32)
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(points)), best].astype(float), 0, 1)
        letters = np.array([len(p) > 0 for p in points], bool)
        known = letters & bool(self.languages)
        languages = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)]
        floor = self.floors[[length_class(len(p)) for p in points]]
        return languages, np.where(known, score, 0.0), ~letters | (score < floor)


def _clusters(vectors: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means; the first centres are texts far from those already taken."""
    centre = vectors.mean(axis=0)
    chosen = vectors[:1]
    while len(chosen) < min(count, len(vectors)):
        chosen = np.vstack([chosen, vectors[(vectors @ chosen.T).max(axis=1).argmin()]])
    for _ in range(8):
        nearest = (vectors @ chosen.T).argmax(axis=1)
        sums = np.stack([vectors[nearest == i].sum(axis=0) if (nearest == i).any() else chosen[i] for i in range(len(chosen))])
        chosen = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return np.vstack([centre / max(float(np.linalg.norm(centre)), 1e-12), chosen])


def fit(texts: list[str], labels: list[str]) -> Model:
    """A model of labelled texts; without any, one that knows no language and rejects everything."""
    rows = [(p.astype(np.uint32), lang) for p, lang in ((code_points(t)[:LETTERS], lang) for t, lang in zip(texts, labels)) if len(p)]
    if not rows:
        return Model([], np.ones(BUCKETS, np.float32), np.zeros((1, BUCKETS), np.float32), np.full(17, np.inf))
    # Only the vectors of one language are in memory at a time.
    seen = np.zeros(BUCKETS, np.int64)
    for p, _ in rows:
        seen += gram_counts(p) > 0
    idf = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
    model, own = Model([], idf, np.zeros((1, BUCKETS), np.float32), np.zeros(17)), {}
    for p, lang in rows:
        own.setdefault(lang, []).append(p)
    parts = [(lang, _clusters(model.vectors(np.stack([gram_counts(p) for p in own[lang]])), CENTROIDS)) for lang in sorted(own)]
    model.languages = [lang for lang, part in parts for _ in part]
    model.centroids = np.vstack([part for _, part in parts]).astype(np.float32)
    reached: dict[int, list[float]] = {}
    for p, _ in rows:  # the whole text and its beginnings: one for each class up to its own
        cuts = [p[: 1 << k] for k in range((len(p) - 1).bit_length() + 1)]
        cosines = model.vectors(np.stack([gram_counts(cut) for cut in cuts])) @ model.centroids.T
        for cut, cosine in zip(cuts, cosines.max(axis=1)):
            reached.setdefault(length_class(len(cut)), []).append(float(cosine))
    known = sorted(reached)
    # Classes beyond the longest text have the floor of the class next to them.
    model.floors = np.interp(range(17), known, [TOLERANCE * float(np.quantile(reached[k], 0.01)) for k in known])
    return model


def _fit_rows(rows: list[tuple]) -> Model:
    """``fit`` of (text, lang, doc_id)."""
    rows = sorted(rows, key=lambda r: (r[1], r[2] is None, 0 if r[2] is None else r[2], r[0]))
    return fit([r[0] for r in rows], [r[1] for r in rows])


def fit_on(documents: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``documents`` (text, lang): about ``sample`` hashed texts of each language come to one task, fewer where
    many languages share ``TEXTS``. Of equal cosines the language that comes first by name wins."""
    labelled = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not sizes:
        return fit([], [])
    sample = min(sample, max(1, TEXTS // len(sizes)))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, sample / n))))
    return fitted(labelled.filter(drawn < share[F.col("lang")]).select("text", "lang", "doc_id"), _fit_rows)


ADDED = ("lang_pred", "lang_score", "lang_rejected")


def _predicted(model: Model, added: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                texts = batch.column("text").to_pylist()
                languages, score, rejected = model.predict([code_points(t or "") for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(languages, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                    names=[*batch.schema.names, *added],
                )

    return run


def identified(documents: DataFrame, model: Model, added: tuple[str, str, str] = ADDED) -> DataFrame:
    """``documents`` with lang_pred, lang_score (0 to 1) and lang_rejected, or columns ``added`` instead of these.

    A missing text, or one without a letter, is ``und``, has score 0 and is rejected. A text counts whole, whatever its
    length; of equal cosines the language that comes first by name wins. Repeated rows are predicted each. Columns of
    the added names are replaced, others pass through.
    """
    plain = documents.drop(*added)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(_predicted(model, added), f"{fields}, `{added[0]}` string, `{added[1]}` double, `{added[2]}` boolean")


def of_known_language(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` less the rejected ones. A model that knows no language has nothing to hold a text against: then
    only missing texts and those without a letter go."""
    if not model.languages:
        model = replace(model, floors=np.zeros(17))
    added = tuple(f"__{name}" for name in ADDED)
    return identified(documents, model, added).filter(~F.col(added[2])).drop(*added)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def digest(documents: DataFrame) -> DataFrame:
    """Prediction of every document; documents whose id's checksum is divisible by five take no part in learning."""
    learned = documents.filter(~held_out() & F.col("doc_id").isNotNull())
    model = fit_on(learned)
    found = identified(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))
