"""Secret scans: fixed patterns, and a small character CNN that judges every other candidate in its context.

Findings of the patterns are the labelled positives, other candidates the negatives; a bounded sample of both is taken.
So that the network learns what keys look like and not what the patterns match, keys are drawn anew over other alphabets
and lengths and put into the contexts of negatives, and things that are no keys (numbers, dates, names, paths) are put
into contexts of both kinds. The network is trained in numpy on part of them, its logits are calibrated on a second part,
and on a third part the threshold is the largest one that keeps the demanded recall. Its findings are added; those of the
patterns stay.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.fitting import fitted
from tidemark.session import workspace

# The patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are whole, so that a shorter run fails and a longer one is one match
KINDS = ("assign", "access", "hex", "model")
#: A run of eight or more characters of a value, with a digit, with a capital after a small letter, or behind a sign.
CANDIDATE = re.compile(
    r"(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/_.-]{8})"
    r"(?:(?=[A-Za-z+/_.-]*[0-9])|(?=[A-Z0-9+/_.-]*[a-z][a-z0-9+/_.-]*[A-Z])|(?<=[:=])|(?<=[:=]\x20)|(?<=[:=][\x22\x27])|(?<=[:=]\x20[\x22\x27]))"
    r"[A-Za-z0-9+/_.-]+={0,2}"
)
LEAST_LENGTH = 8
#: Candidates of each label that a network is trained on, at most.
TRAINING_CANDIDATES = 1_500
#: Keys, and things that are none, that are drawn for training.
DRAWN = 2_500
RECALL = 0.95
#: Below it a span is only added where the recall asks for that.
SURE = 0.9
BEFORE, INSIDE, AFTER = 24, 48, 8
WIDTH = BEFORE + INSIDE + AFTER
FILTERS, REACH = 16, 5

_CLASSES = np.full(128, 13, dtype=np.int64)
for _number, _members in enumerate(["abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/", "_-", "=", "\"'", ":", " \t", "\n\r", ".,;!?"], start=1):
    _CLASSES[[ord(c) for c in _members]] = _number - 1
_PAD = 15  # 13: other ASCII, 14: beyond ASCII
CHANNELS = 17  # 15 classes, vowels, inside the candidate


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Places of candidates; a mark at their end belongs to the sentence."""
    found = ((m.start(), m.start() + len(m[0].rstrip(".-"))) for m in CANDIDATE.finditer(text))
    return [(start, end) for start, end in found if end - start >= LEAST_LENGTH]


def windows(text: str, start: int, end: int) -> list[tuple[str, str, str]]:
    """Context before, part of the candidate, context after; a long candidate gives several parts, so that all is seen."""
    cuts = range(start, end, INSIDE)
    return [(text[max(0, start - BEFORE) : start], text[i : min(end, i + INSIDE)], text[end : end + AFTER]) for i in cuts]


def encode(rows: list[tuple[str, str, str]]) -> np.ndarray:
    """(rows, WIDTH, CHANNELS): class of each character, whether it is a vowel, whether it is of the candidate."""
    out = np.zeros((len(rows), WIDTH, CHANNELS), dtype=np.float32)
    for n, (before, inside, after) in enumerate(rows):
        text = before.rjust(BEFORE, "\0") + inside.ljust(INSIDE, "\0") + after.ljust(AFTER, "\0")
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)[:WIDTH]
        classes = np.where(points == 0, _PAD, np.where(points < 128, _CLASSES[np.minimum(points, 127)], 14))
        real = np.flatnonzero(classes != _PAD)
        out[n, real, classes[real]] = 1
        out[n, :, 15] = np.isin(points, [97, 101, 105, 111, 117])
        out[n, BEFORE : BEFORE + len(inside), 16] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Network:
    """Convolution, ReLU, largest and mean value inside and outside the candidate, logistic output."""

    kernel: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    def forward(self, x: np.ndarray):
        patches = np.lib.stride_tricks.sliding_window_view(x, REACH, axis=1)  # (n, w, channels, reach)
        patches = patches.reshape(len(x), WIDTH - REACH + 1, CHANNELS * REACH)
        active = np.maximum(patches @ self.kernel + self.bias, 0)
        middle = x[:, REACH // 2 : WIDTH - REACH // 2, 16:17]
        share = middle / np.maximum(middle.sum(axis=1, keepdims=True), 1), (1 - middle) / (1 - middle).sum(axis=1, keepdims=True)
        largest = active * middle, active * (1 - middle)
        pooled = np.concatenate([*(p.max(axis=1) for p in largest), *((active * s).sum(axis=1) for s in share)], axis=1)
        return patches, active, middle, share, largest, pooled, pooled @ self.weights + self.offset

    def probability(self, rows: list[tuple[str, str, str]]) -> np.ndarray:
        logits = [self.forward(encode(rows[i : i + 512]))[-1] for i in range(0, len(rows), 512)]
        return _sigmoid(self.slope * np.concatenate(logits) + self.shift) if logits else np.zeros(0)


def _train(x: np.ndarray, y: np.ndarray, rounds: int = 12, rate: float = 0.01) -> Network:
    numbers = np.random.default_rng(7)
    net = Network(numbers.normal(0, 0.15, (CHANNELS * REACH, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  numbers.normal(0, 0.1, 4 * FILTERS).astype(np.float32), 0.0)
    values = [net.kernel, net.bias, net.weights, np.zeros(1, np.float32)]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(rounds):
        order = numbers.permutation(len(x))
        for at in range(0, len(x), 64):
            pick = order[at : at + 64]
            net.offset = float(values[3][0])
            patches, active, middle, share, largest, pooled, logits = net.forward(x[pick])
            error = ((_sigmoid(logits) - y[pick]) / len(pick)).astype(np.float32)
            back = error[:, None] * net.weights[None]
            d_active = np.zeros_like(active)
            rows, filters = np.arange(len(pick))[:, None], np.arange(FILTERS)[None]
            for k, (part, mask) in enumerate(zip(largest, (middle, 1 - middle))):
                top = part.argmax(axis=1)
                d_active[rows, top, filters] += back[:, k * FILTERS : (k + 1) * FILTERS] * mask[:, :, 0][rows, top]
            for k, s in enumerate(share, start=2):
                d_active += back[:, None, k * FILTERS : (k + 1) * FILTERS] * s
            d_active *= active > 0
            slopes = [np.einsum("nwi,nwf->if", patches, d_active), d_active.sum(axis=(0, 1)), pooled.T @ error, np.array([error.sum()])]
            step += 1
            for v, g, m, s in zip(values, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.offset = float(values[3][0])
    return net


def _calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit, by Newton steps on a slightly ridged loss."""
    theta, design = np.array([1.0, 0.0]), np.stack([np.clip(logits, -30, 30), np.ones_like(logits)], axis=1)
    for _ in range(20):
        p = _sigmoid(design @ theta)
        slope = design.T @ (p - y) + 0.1 * (theta - [1.0, 0.0])
        curve = design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        theta = theta - np.linalg.solve(curve, slope)
    return float(max(theta[0], 0.01)), float(theta[1])


def train(rows: list[tuple[str, str, str]], labels: list[int], recall: float = RECALL) -> Network | None:
    """A calibrated network, or none where one of the labels has fewer than ten rows.

    Each row is also shown without its context, so that a candidate can convince by itself.
    """
    y = np.array(labels, dtype=float)
    if min((y == 1).sum(), (y == 0).sum()) < 10:
        return None
    digests = [hashlib.sha256("\0".join(r).encode("utf-8", "surrogatepass")).digest()[0] % 5 for r in rows]
    part = np.array(digests)
    x, bare = encode(rows), encode([("", inside, "") for _, inside, _ in rows])
    if any(min((y[m] == 1).sum(), (y[m] == 0).sum()) < 2 for m in (part < 3, part == 3, part == 4)):
        part = np.arange(len(rows)) % 5
    fitted = part < 3
    net = _train(np.concatenate([x[fitted], bare[fitted]]), np.concatenate([y[fitted], y[fitted]]))
    net.slope, net.shift = _calibrate(net.forward(x[part == 3])[-1], y[part == 3])
    probability = _sigmoid(net.slope * net.forward(x[part == 4])[-1] + net.shift)
    found = np.sort(probability[y[part == 4] == 1])[::-1]
    # The recall is a floor: a lower threshold is taken only where it asks for one.
    net.threshold = min(SURE, float(found[min(len(found) - 1, int(np.ceil(recall * len(found))) - 1)])) if len(found) else SURE
    return net


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets of drawn keys, by the kind of finding that looks like them.
ALPHABETS = {
    "assign": (_LOWER + _DIGITS, _LOWER + _UPPER + _DIGITS, _LOWER + _UPPER + _DIGITS + "+/", _LOWER + _UPPER + _DIGITS + "-_"),
    "access": (_UPPER + _DIGITS, _UPPER + "234567"),
    "hex": ("0123456789abcdef", "0123456789ABCDEF"),
}
_SIGNS = ("key: ", "pwd: ", "pass=", "auth = ", "id: ", "value=", "credential: \"", "k='", "sig=", "ref: ")


def _key(r: random.Random, alphabets: list[str]) -> str:
    """Random characters of a length from 8 to 64, at times behind a name as issuers put one."""
    alphabet = r.choice(alphabets)
    size = int(8 * 2 ** r.uniform(0, 3))
    while True:
        key = "".join(r.choices(alphabet, k=size))
        if any(c.isdigit() for c in key) and any(c.isalpha() for c in key):
            break
    if r.random() < 0.25:
        name = "".join(r.choices(_LOWER if r.random() < 0.8 else _UPPER, k=r.randint(2, 4)))
        key = name + r.choice("_-") + (r.choice(("live", "test", "prod", "v2", "key")) + r.choice("_-") if r.random() < 0.4 else "") + key
    return key + ("=" * r.choice((0, 0, 1, 2)) if "/" in alphabet else "")


def _word(r: random.Random, words: list[str]) -> str:
    if words and r.random() < 0.7:
        return r.choice(words)
    return "".join(r.choice("bcdfghklmnprstvw") + r.choice("aeiou") + r.choice(("", "", "n", "r", "s")) for _ in range(r.randint(2, 4)))


def _no_key(r: random.Random, words: list[str]) -> str:
    """Numbers, dates, addresses, names and paths of eight or more characters."""
    word, digits = lambda: _word(r, words).lower(), lambda n: "".join(r.choices(_DIGITS, k=n))
    mark = r.choice("-_./")
    forms = (
        lambda: digits(r.randint(8, 20)),
        lambda: ".".join(digits(r.randint(1, 3)) for _ in range(4)),
        lambda: "-".join(digits(r.randint(2, 5)) for _ in range(r.randint(2, 4))),
        lambda: f"{r.randint(1900, 2100)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}" + r.choice(("", f"T{r.randint(0, 23):02}", "Z")),
        lambda: f"{digits(r.randint(1, 4))}.{digits(r.randint(4, 12))}",
        lambda: mark.join(word() for _ in range(r.randint(1, 4))),
        lambda: mark.join(word() for _ in range(r.randint(1, 3))) + mark + digits(r.randint(1, 4)),
        lambda: word() + digits(r.randint(1, 4)),
        lambda: word() + digits(r.randint(1, 2)) + mark + word(),
        lambda: word() + "".join(word().capitalize() for _ in range(r.randint(1, 3))),
        lambda: "".join(word().capitalize() for _ in range(r.randint(2, 4))),
        lambda: "_".join(word() for _ in range(r.randint(1, 3))).upper() + r.choice(("", "_" + digits(2))),
        lambda: f"www.{word()}.{r.choice(('org', 'com', 'net', 'de'))}/{word()}/{word()}.{r.choice(('html', 'pdf', 'txt', 'mp3'))}",
        lambda: f"{word()}{mark}v{r.randint(0, 20)}.{r.randint(0, 20)}.{r.randint(0, 9)}",
        lambda: word() + word(),
    )
    while True:
        found = r.choice(forms)()
        if len(found) >= LEAST_LENGTH:
            return found


def augmented(
    rows: list[tuple[str, str, str]], labels: list[int], leave_out: str | None = None, drawn: int = DRAWN
) -> tuple[list[tuple[str, str, str]], list[int]]:
    """The rows with drawn keys and drawn things that are none, in the rows' own contexts and behind signs.

    ``leave_out`` names a kind whose alphabets are not drawn. Tables without a row of either label are filled as well.
    """
    r = random.Random(11)
    contexts = [(before, after) for before, _, after in (row for row, label in zip(rows, labels) if not label)] or [("", "")]
    words = sorted({w for before, inside, after in rows for w in re.findall(r"(?<![A-Za-z])[A-Za-z][a-z]{2,11}(?![A-Za-z])", f"{before} {after}")})
    alphabets = [a for kind, all_ in ALPHABETS.items() if kind != leave_out for a in all_]
    told = [before for (before, _, _), label in zip(rows, labels) if label] + list(_SIGNS)

    def around() -> tuple[str, str]:
        before, after = r.choice(contexts)
        if r.random() < 0.3:
            before = (before[: len(before) // 2] + r.choice(told))[-BEFORE:]
        elif r.random() < 0.4:
            before = " ".join([*(_word(r, words) for _ in range(3)), ""])[-BEFORE:]
            after = r.choice((" ", ".", ",", "\n", ")", ""))
        return before, after[:AFTER]

    more, marks = [], []
    for make, label in ((lambda: _key(r, alphabets), 1), (lambda: _no_key(r, words), 0)):
        for _ in range(drawn):
            (before, after), inside = around(), make()
            if not label and r.random() < 0.15:  # the name of a key that follows
                after = (r.choice(("=", ": ", '="', " = ")) + _key(r, alphabets))[:AFTER]
            for part in windows(before + inside + after, len(before), len(before) + len(inside)):
                more.append(part)
                marks.append(label)
    return rows + more, labels + marks


def _examples(most: int):
    """Labelled windows of all candidates; a task keeps the ``most`` smallest by hash of each label, each window once."""

    def order(row: tuple[str, str, str]) -> int:
        return int.from_bytes(hashlib.blake2b("\0".join(row).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[dict, dict] = ({}, {})
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                base = base_spans(text)
                for start, end in candidates(text):
                    label = int(any(s < end and start < e for _, s, e in base))
                    kept[label].update((w, order(w)) for w in windows(text, start, end))
                    if len(kept[label]) > 4 * most + 1000:
                        least = sorted(kept[label].items(), key=lambda x: (x[1], x[0]))[:most]
                        kept[label].clear()
                        kept[label].update(least)
        for label, found in enumerate(kept):
            rows = sorted(found.items(), key=lambda x: (x[1], x[0]))[:most]
            columns = list(zip(*(w for w, _ in rows))) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.string()) for c in columns), pa.array([n for _, n in rows], pa.int64()), pa.array([label] * len(rows), pa.int32())],
                names=["before", "inside", "after", "order", "label"],
            )

    return run


def fit(rows: list[tuple[str, str, str]], labels: list[int], leave_out: str | None = None) -> Network:
    """A network of labelled windows and drawn ones.

    A candidate that no pattern finds is unlabelled rather than none: keys without a pattern are among them. Those that a
    first network is sure of, which has not seen any of them, do not count as negatives.
    """
    told = [row for row, label in zip(rows, labels) if label]
    others = [row for row, label in zip(rows, labels) if not label]
    first = train(*augmented(told, [1] * len(told), leave_out))
    others = [row for row, p in zip(others, first.probability(others)) if p < SURE]
    return train(*augmented(told + others, [1] * len(told) + [0] * len(others), leave_out))


def _fit_examples(rows: list[tuple]) -> Network:
    rows = sorted(rows, key=lambda r: (r[4], r[3], *r[:3]))
    return fit([r[:3] for r in rows], [r[4] for r in rows])


def train_on(documents: DataFrame, most_candidates: int = TRAINING_CANDIDATES) -> Network:
    """A network trained on a hashed sample of the labelled candidates of all documents, ``most_candidates`` of a label at
    most, and on what ``fit`` draws: a table without any candidate gives a network, too. It is trained in a task."""
    spark = documents.sparkSession
    folder = workspace(spark, "secret-scan")
    schema = "before string, inside string, after string, order long, label int"
    documents.select("text").mapInArrow(_examples(most_candidates), schema).write.parquet(f"{folder}/examples")
    found = spark.read.parquet(f"{folder}/examples").distinct()
    # An order of hashes, cut off, is a sample; what a task has cut off lies behind its own first rows.
    none, some = (found.filter(F.col("label") == label).orderBy("order", "before", "inside", "after").limit(most_candidates) for label in (0, 1))
    return fitted(none.union(some), _fit_examples)


def find(text: str, net: Network | None) -> list[tuple[str, int, int]]:
    """All spans of a text, in order of their start, then kind."""
    return find_all([text], net)[0]


def find_all(texts: list[str], net: Network | None) -> list[list[tuple[str, int, int]]]:
    base, places, rows = [base_spans(t) for t in texts], [], []
    if net is not None:
        for n, text in enumerate(texts):
            for start, end in candidates(text):
                if not any(s < end and start < e for _, s, e in base[n]):
                    parts = windows(text, start, end)
                    places += [(n, start, end)] * len(parts)
                    rows += parts
        added = {place for place, p in zip(places, net.probability(rows)) if p >= net.threshold}
        for n, start, end in added:
            base[n].append(("model", start, end))
    return [sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))) for spans in base]


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[secret]") -> str:
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scanned(documents: DataFrame, net: Network | None, spans: str = "secret_spans", clean: str = "text_redacted") -> DataFrame:
    """``documents`` with ``spans`` ("kind:start:end,...", code points, end exclusive) and the text without them in ``clean``.

    A missing text has no spans and stays missing; an empty one has none. A text is scanned whole, whatever its length, and
    a long candidate is judged in parts. Spans that start together go in the order of kinds. Repeated rows are scanned
    each. Columns of the two names are replaced, others pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column("text").to_pylist()
                found = find_all([t or "" for t in texts], net)
                without = [t if not s else redacted(t, s) for t, s in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(map(_joined, found), pa.string()), pa.array(without, pa.string())],
                    names=[*batch.schema.names, spans, clean],
                )

    plain = documents.drop(spans, clean)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(run, f"{fields}, `{spans}` string, `{clean}` string")


def digest(documents: DataFrame) -> DataFrame:
    rows = scanned(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train_on(documents))
    spans = F.filter(F.split("secret_spans", ","), lambda s: s != "")
    base = F.filter(spans, lambda s: ~s.startswith("model:"))
    count = lambda kind: F.size(F.filter(spans, lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")
    sha = F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *map(count, KINDS[:3]), sha, F.col("secret_spans").alias("spans"), count("model"))
