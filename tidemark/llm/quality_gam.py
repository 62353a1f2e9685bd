"""Quality classifier: a generalised additive model with pairwise interactions.

Each measure of a text is cut into bins. Boosting visits the measures in turn and adds a shallow tree over the bins of one
of them to its lookup table; then the pairs of measures that explain most of what is left get tables of two dimensions in
the same way. A score is the sum of one entry per table, through the logistic function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.skew import join_aggregate
from tidemark.llm.words import shingles, spans, text_bytes, word_hashes
from tidemark.session import workspace

#: Labelled rows that the driver gets, at most: measures, not texts.
TRAINING_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 12, 8
ROUNDS, RATE, RIDGE = 300, 0.1, 2.0
#: Rounds without a gain on the rows that are kept back, until boosting stops.
PATIENCE = 20
TEXTS_AT_ONCE = 256

MEASURES = (
    "words", "word_length", "longest_word", "upper", "digits", "symbols", "marks", "shouts", "beyond_ascii", "spaces", "entropy",
    "words_per_mark", "words_per_line", "repeated_lines", "distinct_words", "top_word", "echoes", "repeated_windows", "short_words",
    "lettered_words",
)

_CLASS = np.zeros((256, 8), dtype=bool)
for _column, _members in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>~^_=+{}[]@/\\", b".,;:?", b"!", bytes(range(128, 256)), b" \t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz"]):
    _CLASS[list(_members), _column] = True
_LETTER = _CLASS[:, 0] | _CLASS[:, 7] | _CLASS[:, 5]


def measures(texts: pa.Array) -> np.ndarray:
    """(texts, measures), each over the whole text; a missing, empty or blank text has only zeros in its word measures."""
    out = np.zeros((len(texts), len(MEASURES)))
    data, ends = text_bytes(texts)
    first, last, at = spans(data, ends)
    hashes = word_hashes(data, first, last)
    lettered = np.concatenate([[0], np.cumsum(_LETTER[data])])
    full = lettered[last] - lettered[first] == last - first
    for n in range(len(texts)):
        raw = data[ends[n] : ends[n + 1]]
        if not len(raw):
            continue
        counts = np.bincount(raw, minlength=256)
        upper, digits, symbols, marks, shouts, beyond, spaces, lower = (counts @ _CLASS).tolist()
        share = counts[counts > 0] / len(raw)
        entropy = float(-(share * np.log2(share)).sum())
        letters = max(1, upper + lower)
        row = [0, 0, 0, upper / letters, digits / len(raw), symbols / len(raw), marks / len(raw), shouts / len(raw), beyond / len(raw), spaces / len(raw), entropy]
        words = hashes[at[n] : at[n + 1]]
        if len(words):
            sizes = last[at[n] : at[n + 1]] - first[at[n] : at[n + 1]]
            _, often = np.unique(words, return_counts=True)
            lines = raw.tobytes().split(b"\n")
            worded = [line for line in lines if line.strip()]
            row[:3] = np.log1p(len(words)), float(sizes.mean()), np.log1p(float(sizes.max()))
            row += [
                np.log1p(len(words) / (1 + counts[[46, 33, 63]].sum())), np.log1p(len(words) / max(1, len(worded))),
                1 - len(set(worded)) / max(1, len(worded)), len(often) / len(words), often.max() / len(words),
                float((words[1:] == words[:-1]).mean()) if len(words) > 1 else 0.0,
                1 - len(shingles(words, 3)) / max(1, len(words) - 2), float((sizes <= 3).mean()), float(full[at[n] : at[n + 1]].mean()),
            ]
        out[n, : len(row)] = row
    return out


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, values[:, f], side="right") for f, e in enumerate(edges)], axis=1) if len(edges) else np.zeros((len(values), 0), int)


def _edges(values: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in values.T]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Bin edges, one table per measure, and one per chosen pair of measures."""

    offset: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def logits(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), self.offset)
        fine, coarse = _binned(values, self.edges), _binned(values, self.coarse)
        for f, table in enumerate(self.tables):
            out += table[fine[:, f]]
        for (f, g), grid in zip(self.pairs, self.grids):
            out += grid[coarse[:, f], coarse[:, g]]
        return out

    def scores(self, values: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(values))


def _gain(slope, curve):
    return slope * slope / (curve + RIDGE)


def _cut(slope: np.ndarray, curve: np.ndarray) -> int | None:
    """The bin before which a sequence is cut best, if cutting helps."""
    if len(slope) < 2:
        return None
    a, h = np.cumsum(slope)[:-1], np.cumsum(curve)[:-1]
    gains = _gain(a, h) + _gain(slope.sum() - a, curve.sum() - h) - _gain(slope.sum(), curve.sum())
    best = int(gains.argmax())
    return best + 1 if gains[best] > 1e-9 else None


def shallow_tree(slope: np.ndarray, curve: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step for every bin: a tree of ``depth`` cuts over the bins, each leaf a ridged Newton step."""
    at = _cut(slope, curve) if depth else None
    if at is None:
        return np.full(len(slope), slope.sum() / (curve.sum() + RIDGE))
    return np.concatenate([shallow_tree(slope[:at], curve[:at], depth - 1), shallow_tree(slope[at:], curve[at:], depth - 1)])


def crossed_tree(slope: np.ndarray, curve: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step of the tree that cuts a grid best into four quadrants."""
    a, h = slope.cumsum(0).cumsum(1), curve.cumsum(0).cumsum(1)
    parts = lambda x: (x, x[:, -1:] - x, x[-1:, :] - x, x[-1, -1] - x[:, -1:] - x[-1:, :] + x)
    quarters = list(zip(parts(a), parts(h)))
    gains = sum(_gain(s, c) for s, c in quarters)
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    steps = [s[i, j] / (c[i, j] + RIDGE) for s, c in quarters]
    low, left = np.arange(slope.shape[0])[:, None] <= i, np.arange(slope.shape[1])[None] <= j
    step = np.where(low, np.where(left, steps[0], steps[1]), np.where(left, steps[2], steps[3]))
    return float(gains[i, j] - _gain(a[-1, -1], h[-1, -1])), step


def _boosted(parts: list, codes: list[np.ndarray], sizes: list[int], step_of, y: np.ndarray, logits: np.ndarray, fitted: np.ndarray) -> np.ndarray:
    """Visits ``parts`` (tables) in turn until the rows kept back gain nothing; leaves the tables of the best round."""
    loss = lambda z: float(np.logaddexp(0, np.where(y >= 0.5, -z, z))[~fitted].mean()) if (~fitted).any() else 0.0
    best, kept, kept_logits, since = loss(logits), [t.copy() for t in parts], logits.copy(), 0
    for _ in range(ROUNDS):
        for k, code in enumerate(codes):
            p = sigmoid(logits)
            slope = np.bincount(code[fitted], (y - p)[fitted], sizes[k])
            curve = np.bincount(code[fitted], (p * (1 - p))[fitted], sizes[k])
            step = RATE * step_of(slope, curve, parts[k].shape)
            parts[k] += step
            logits = logits + step.reshape(-1)[code]
        now = loss(logits)
        if now < best - 1e-6:
            best, kept, kept_logits, since = now, [t.copy() for t in parts], logits.copy(), 0
        else:
            since += 1
            if since >= PATIENCE:
                break
    for k, table in enumerate(kept):
        parts[k][...] = table
    return kept_logits


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """A model of rows (measures) and labels (0 to 1, the share of votes for good).

    Every fifth row is kept back to end boosting. Rows of one label alone, or none, give the smoothed share of the label.
    """
    y = np.asarray(labels, dtype=float)
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(offset=float(np.log(share / (1 - share))))
    if len(y) < 10 or len(np.unique(y >= 0.5)) < 2:
        return model
    fitted = np.arange(len(y)) % 5 != 4
    model.edges, model.coarse = _edges(values[fitted], BINS), _edges(values[fitted], PAIR_BINS)
    fine, coarse = _binned(values, model.edges), _binned(values, model.coarse)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    logits = np.full(len(y), model.offset)
    tree = lambda slope, curve, shape: shallow_tree(slope, curve)
    logits = _boosted(model.tables, list(fine.T), [len(t) for t in model.tables], tree, y, logits, fitted)

    p = sigmoid(logits)
    found = []
    for f in range(values.shape[1]):
        for g in range(f):
            shape = (len(model.coarse[f]) + 1, len(model.coarse[g]) + 1)
            code = (coarse[:, f] * shape[1] + coarse[:, g])[fitted]
            sums = [np.bincount(code, w[fitted], shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p))]
            found.append((crossed_tree(*sums)[0], f, g, shape))
    found.sort(key=lambda x: (-x[0], x[1], x[2]))
    model.pairs = [(f, g) for _, f, g, _ in found[:PAIRS]]
    model.grids = [np.zeros(shape) for *_, shape in found[:PAIRS]]
    codes = [coarse[:, f] * grid.shape[1] + coarse[:, g] for (f, g), grid in zip(model.pairs, model.grids)]
    cross = lambda slope, curve, shape: crossed_tree(slope.reshape(shape), curve.reshape(shape))[1]
    _boosted(model.grids, codes, [grid.size for grid in model.grids], cross, y, logits, fitted)
    return model


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
            batch = whole.slice(at, TEXTS_AT_ONCE)
            found = measures(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * len(MEASURES), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "measures"])


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("measures").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(model.scores(values))], names=["doc_id", "held_out", "score"])

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_on(measured: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Model:
    """A model of the labelled rows that are not held out, the ``most`` smallest by hash at most.

    A document with several labels has their mean; labels other than 0 and 1, and rows without an id, are left out.
    """
    votes = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("label"))
    rows = join_aggregate(measured.filter(~F.col("held_out")), votes, "doc_id")
    order = F.xxhash64("doc_id", "measures")
    found = rows.select("measures", "label", order.alias("order")).orderBy("order", "measures").limit(most).toPandas()
    if not len(found):
        return fit(np.zeros((0, len(MEASURES))), np.zeros(0))
    return fit(np.stack(found["measures"].to_numpy()), found["label"].to_numpy())


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out and score (0 to 1, higher where quality 1 is likelier) of every row of ``documents``.

    Rows whose id's checksum leaves 1 divided by three are held out of learning; rows without an id take no part in it and
    are not held out. Missing texts count as empty; empty and blank texts get a score as others do. Texts are measured
    whole, whatever their length, a few hundred at a time. Repeated rows are scored each. Without labels of both kinds the
    score is the smoothed share of good labels (0.5 without any). An empty table gives no row; other columns are not read.
    """
    folder = workspace(documents.sparkSession, "quality-gam")
    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plain.mapInArrow(_measured, "doc_id long, measures array<double>").write.parquet(f"{folder}/measures")
    measured = documents.sparkSession.read.parquet(f"{folder}/measures").withColumn("held_out", held_out())
    return measured.mapInArrow(_scored(fit_on(measured, labels)), "doc_id long, held_out boolean, score double")


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(documents, labels).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
