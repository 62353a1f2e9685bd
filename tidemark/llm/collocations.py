"""Phrase collocations by vertical partitioning of a suffix tree over words.

Each word position of a text starts a window of at most five words that does not leave its piece. The windows are the
suffixes of a tree cut at depth five. Prefixes of the tree are put into groups that hold no more windows than a task's
memory budget: a prefix with more is extended by a word, as often as it takes. Every group is sent its windows, builds its
subtrees by itself, and reads the count of each phrase from the totals of the leaves below it. Prefixes that were
extended have their counts from the pass that found them too large.

A word is named by a 64-bit hash of language and word, so that windows of different languages never meet. (Two of m words
share a hash with a chance of about m² / 2^65.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.words import LOWER, mix, spans, text_bytes, word_hashes
from tidemark.session import workspace

LONGEST, LEAST, FIRST = 5, 100, 2000
#: Windows of a group, about: what one task sorts in memory.
BUDGET = 1_000_000
#: Prefixes of a level, the most frequent ones, whose group the tasks look up in a table; rarer ones go by their hash.
LISTED = 1 << 18
#: Bytes of text that are taken apart together, and word positions that are sorted together before they are sent.
AT_ONCE = 6_000_000
STRETCH = 1 << 19

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[0x20, 0x09]] = True
_NEXT = np.uint64(0xD1342543DE82EF95)


def language_seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))


def extended(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Name of a prefix and one more word."""
    return mix(prefix * _NEXT + word)


def words_of(texts: pa.Array, lang: str):
    """(names, rest, bytes, first, last): every word's name, how many words of its piece begin at it, and where it lies."""
    data, ends = text_bytes(texts)
    data = LOWER[data]
    first, last, at = spans(data, ends, _SEPARATOR)
    names = mix(word_hashes(data, first, last) + language_seed(lang))
    if not len(first):
        return names, np.zeros(0, np.int64), data, first, last
    breaks = np.flatnonzero(_BREAK[data])
    ending = np.ones(len(first), dtype=bool)
    ending[:-1] = np.searchsorted(breaks, first[1:]) > np.searchsorted(breaks, last[:-1])
    starts = at[1:-1]  # the first word of a text ends the piece before it
    ending[starts[(starts > 0) & (starts < len(first))] - 1] = True
    stops = np.flatnonzero(ending)
    rest = stops[np.searchsorted(stops, np.arange(len(first)))] - np.arange(len(first)) + 1
    return names, rest, data, first, last


def _by_language(batches: Iterator[pa.RecordBatch]):
    """(lang, texts) of batches of text and lang, some megabytes at a time; a text is never cut."""
    for batch in batches:
        for lang in batch.column("lang").unique().to_pylist():
            texts = batch.filter(pc.equal(batch.column("lang"), lang)).column("text")
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + AT_ONCE, side="right")))
                yield lang, texts.slice(lo, hi - lo)
                lo = hi


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _by_language(batches):
        names, _, data, first, last = words_of(texts, lang)
        keys, places, counts = np.unique(names, return_index=True, return_counts=True)
        raw = data.tobytes()
        words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(first[places].tolist(), last[places].tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(words, pa.string()), pa.array(counts.astype(np.int64))],
            names=["lang", "name", "word", "n"],
        )


@dataclass
class Level:
    """Groups of the prefixes of one length: listed ones by table (-1: extended by a word), others by their hash.

    ``whole`` says that every prefix that counts is listed; others have no group then. Otherwise unlisted prefixes share
    ``spread`` groups from ``start`` on. Prefixes with more than ``limit`` windows are extended.
    """

    keys: np.ndarray
    groups: np.ndarray
    limit: int
    whole: bool
    start: int
    spread: int

    def of(self, names: np.ndarray) -> np.ndarray:
        """Group of each prefix; -1: extended, -2: none."""
        out = np.full(len(names), -2, dtype=np.int64)
        if not self.whole:
            out = (self.start + (names % np.uint64(self.spread)).astype(np.int64))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, names), len(self.keys) - 1)
            hit = self.keys[at] == names
            out[hit] = self.groups[at[hit]]
        return out


@dataclass
class Grouping:
    """The levels so far: one for each length of prefix."""

    levels: list[Level] = field(default_factory=list)
    groups: int = 0

    def add(self, keys: np.ndarray, counts: np.ndarray, others: int, budget: int) -> None:
        """Takes the prefixes of the next length, most frequent first; ``others`` windows have a prefix that is not listed.

        An unlisted prefix is never extended, so that the limit is not below the least listed count then.
        """
        limit = max(budget, int(counts[-1])) if others and len(counts) else budget
        large = counts > limit if len(self.levels) + 1 < LONGEST else np.zeros(len(counts), dtype=bool)
        groups = np.full(len(counts), -1, dtype=np.int64)
        groups[~large] = self.groups + (np.cumsum(counts[~large]) - 1) // max(1, budget)
        start, spread = max(self.groups, int(groups.max(initial=-1)) + 1), -(-others // budget)
        order = np.argsort(keys)
        self.levels.append(Level(keys[order], groups[order], limit, others == 0, start, max(1, spread)))
        self.groups = start + spread

    @property
    def open(self) -> bool:
        """Whether prefixes of the last level are to be extended."""
        return bool((self.levels[-1].groups == -1).any())


def _reach(names: np.ndarray, rest: np.ndarray, level: Level) -> np.ndarray:
    """Words of each window: it ends with its piece, at five words, or before a word that does not count."""
    if level.whole:
        counting = level.of(names) != -2
        stops = np.flatnonzero(np.append(~counting, True))
        here = np.arange(len(names))
        rest = np.minimum(rest, stops[np.searchsorted(stops, here)] - here)
    return np.minimum(rest, LONGEST)


def _extending(grouping: Grouping):
    """Counts the extensions of the prefixes that the last level left open."""
    depth = len(grouping.levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _by_language(batches):
            names, rest, *_ = words_of(texts, lang)
            reach = _reach(names, rest, grouping.levels[0])
            at, prefix = _open(grouping, names, reach)
            longer = reach[at] > depth
            at, prefix = at[longer], prefix[longer]
            keys, once, counts = np.unique(extended(prefix, names[at + depth]), return_index=True, return_counts=True)
            phrases = np.stack([names[at[once] + k] for k in range(depth + 1)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), _lists(phrases), pa.array(counts.astype(np.int64))],
                names=["lang", "name", "words", "n"],
            )

    return run


def _lists(phrases: np.ndarray) -> pa.Array:
    """Rows of word names as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(phrases) + 1) * phrases.shape[1], pa.int32()), pa.array(phrases.ravel().view(np.int64)))


def _open(grouping: Grouping, names: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose prefix is open at every level, and the names of these prefixes."""
    at, prefix = np.flatnonzero(reach > 0), None
    for depth, level in enumerate(grouping.levels):
        if prefix is None:
            prefix = names[at]
        else:
            longer = reach[at] > depth
            at, prefix = at[longer], prefix[longer]
            prefix = extended(prefix, names[at + depth])
        still = level.of(prefix) == -1
        at, prefix = at[still], prefix[still]
    return at, prefix


def _grouped(grouping: Grouping, names: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """The group of the window at each position; -1 without one.

    A window that ends before its prefix has a group of its own belongs to an extended prefix, which is counted already.
    """
    out = np.full(len(names), -1, dtype=np.int64)
    at = np.flatnonzero(reach > 0)
    prefix = names[at]
    for depth, level in enumerate(grouping.levels):
        if depth:
            longer = reach[at] > depth
            at, prefix = at[longer], prefix[longer]
            prefix = extended(prefix, names[at + depth])
        group = level.of(prefix)
        settled = group >= 0
        out[at[settled]] = group[settled]
        at, prefix = at[group == -1], prefix[group == -1]
    return out


def _planes(column: np.ndarray) -> bytes:
    """Numbers byte by byte: equal high bytes lie together and pack well."""
    return np.ascontiguousarray(column.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def packed(windows: np.ndarray, counts: np.ndarray, listed: int, strange: np.ndarray) -> bytes:
    """Distinct windows with their counts: 0 behind the end, words by number.

    Numbers up to ``listed`` are those of listed words, larger ones those of ``strange`` names, which the block brings along.
    """
    names = np.zeros(0, np.uint64)
    if len(strange):
        used = np.unique(windows[windows > listed])
        names = strange[used - listed - 1]
        windows = np.where(windows > listed, listed + 1 + np.searchsorted(used, windows), windows)
    head = np.array([len(windows), len(names)], dtype="<u4").tobytes()
    return head + names.astype("<u8").tobytes() + b"".join(_planes(windows[:, k]) for k in range(LONGEST)) + _planes(counts)


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, counts and strange names of a block."""
    size, strangers = np.frombuffer(block, "<u4", 2).tolist()
    planes = np.frombuffer(block, np.uint8, 4 * size * (LONGEST + 1), 8 + 8 * strangers).reshape(LONGEST + 1, 4, size)
    columns = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4")[:, :, 0]
    return columns[:LONGEST].T.astype(np.int32), columns[LONGEST].astype(np.int64), np.frombuffer(block, "<u8", strangers, 8).astype(np.uint64)


def merged(blocks: list[bytes], listed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows and counts of blocks, in order, and the strange names in all of them; a window can be there repeatedly."""
    parts = [unpacked(b) for b in blocks]
    strange = np.unique(np.concatenate([names for *_, names in parts]))
    for windows, _, names in parts:
        if len(names):
            numbers = np.searchsorted(strange, names).astype(np.int32)
            far = windows > listed
            windows[far] = listed + 1 + numbers[windows[far] - listed - 1]
    windows, counts = np.concatenate([w for w, *_ in parts]), np.concatenate([n for _, n, _ in parts])
    order = np.lexsort([windows[:, k] for k in reversed(range(LONGEST))])
    return windows[order], counts[order], strange


def _sent(grouping: Grouping):
    """The windows of every group in a stretch of text, each distinct one once."""
    listed = grouping.levels[0].keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _by_language(batches):
            names, rest, *_ = words_of(texts, lang)
            reach = _reach(names, rest, grouping.levels[0])
            group = _grouped(grouping, names, reach)
            # Numbers of the words: 1 and up for listed ones, then those of the strange ones of these texts.
            at = np.minimum(np.searchsorted(listed, names), max(0, len(listed) - 1))
            known = listed[at] == names if len(listed) else np.zeros(len(names), dtype=bool)
            strange = np.zeros(0, np.uint64) if grouping.levels[0].whole else np.unique(names[~known])
            number = np.where(known, at + 1, len(listed) + 1 + np.searchsorted(strange, names))
            number = np.concatenate([number, np.zeros(LONGEST, np.int64)])
            for lo in range(0, len(names), STRETCH):
                at = lo + np.flatnonzero(group[lo : lo + STRETCH] >= 0)
                if not len(at):
                    continue
                windows = np.stack([np.where(reach[at] > k, number[at + k], 0) for k in range(LONGEST)], axis=1)
                name = windows[:, 0].astype(np.uint64)
                for k in range(1, LONGEST):
                    name = extended(name, windows[:, k].astype(np.uint64))
                _, once, counts = np.unique(name, return_index=True, return_counts=True)
                order = np.lexsort([windows[once, 1], windows[once, 0], group[at[once]]])
                once, counts = once[order], counts[order]
                own = group[at[once]]
                cuts = np.flatnonzero(np.diff(own)) + 1
                blocks = [packed(w, n, len(listed), strange) for w, n in zip(np.split(windows[once], cuts), np.split(counts, cuts))]
                numbers = own[np.concatenate([[0], cuts])]
                for k in range(0, len(blocks), 500):
                    part = blocks[k : k + 500]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers[k : k + 500]), pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary())], names=["group", "lang", "block"]
                    )

    return run


def subtrees(windows: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases, counts) of the nodes of each depth with ``least`` occurrences or more, for windows in order.

    The rows are the leaves; rows with the same words up to a depth lie side by side and are one node of that depth.
    """
    new = np.ones(len(windows), dtype=bool)
    for depth in range(1, LONGEST + 1):
        column = windows[:, depth - 1]
        if depth == 1:
            new[1:] = column[1:] != column[:-1]
        else:
            new[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(counts, starts)
        kept = (totals >= least) & (column[starts] != 0)
        yield windows[starts[kept], :depth], totals[kept]


def _counted(listed: np.ndarray, least: int):
    """Builds the subtrees of a group and gives its phrases with ``least`` occurrences or more."""

    def run(table: pa.Table) -> pa.Table:
        found = []
        for lang in table.column("lang").unique().to_pylist():
            windows, counts, strange = merged(table.filter(pc.equal(table.column("lang"), lang)).column("block").to_pylist(), len(listed))
            names = np.concatenate([np.zeros(1, np.uint64), listed, strange])
            for phrases, totals in subtrees(windows, counts, least):
                found.append(pa.table({"lang": pa.array([lang] * len(totals), pa.string()), "words": _lists(names[phrases]), "f": pa.array(totals)}))
        return pa.concat_tables(found)

    return run


def _most(counts: DataFrame, least: int, listed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``listed`` most frequent names among those with ``least`` occurrences, their counts, and the windows of all
    others if some of those are not listed, else 0."""
    rows = counts.filter(F.col("n") >= least).select("name", "n").orderBy(F.desc("n"), "name").limit(listed).toPandas()
    n = rows["n"].to_numpy(np.int64)
    total = counts.agg(F.sum("n").alias("all"), F.count_if(F.col("n") >= least).alias("frequent")).first()
    return rows["name"].to_numpy(np.int64).view(np.uint64), n, int(total["all"] - n.sum()) if total["frequent"] > len(n) else 0


def phrase_counts(spark: SparkSession, documents: DataFrame, folder: str, least: int = LEAST, budget: int = BUDGET, listed: int = LISTED) -> DataFrame:
    """(lang, words, f): every phrase of one to five words with ``least`` occurrences or more, words as names.

    ``folder``/words gets the counts of all words: lang, name, word, n. The texts are read once for them, once for each
    further length of too frequent prefixes, and once for the windows. What the tasks get of the words and longer
    prefixes is bounded by ``listed`` entries a level, at most five levels.
    """
    plain = documents.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    words = plain.mapInArrow(_counted_words, "lang string, name long, word string, n long")
    words.groupBy("lang", "name", "word").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    grouping, counts, above = Grouping(), words.withColumn("words", F.array("name")), []
    while True:
        grouping.add(*_most(counts, least, listed), budget)
        if not grouping.open:
            break
        # Too frequent prefixes are nodes above the subtrees.
        above.append(counts.filter(F.col("n") > grouping.levels[-1].limit).select("lang", "words", F.col("n").alias("f")))
        level = plain.mapInArrow(_extending(grouping), "lang string, name long, words array<long>, n long").groupBy("lang", "name", "words").agg(F.sum("n").alias("n"))
        level.write.parquet(f"{folder}/prefixes-{len(grouping.levels)}")
        counts = spark.read.parquet(f"{folder}/prefixes-{len(grouping.levels)}")
    sent = plain.mapInArrow(_sent(grouping), "`group` long, lang string, block binary")
    found = sent.groupBy("group").applyInArrow(_counted(grouping.levels[0].keys, least), "lang string, words array<long>, f long")
    return reduce(DataFrame.union, above, found)


def score_of(a: str, n: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000 * a * n / (l * r)); counts have up to 14 digits, so that decimals of 38 digits hold the products exactly."""
    large = [f"cast({c} as decimal(14, 0))" for c in (a, n, l, r)]
    return F.expr(f"(1000BD * {large[0]} * {large[1]}) div ({large[2]} * {large[3]})")


def collocations(spark: SparkSession, documents: DataFrame, least: int = LEAST, first: int = FIRST, budget: int = BUDGET, listed: int = LISTED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` collocations of every language.

    Missing and empty texts have no words; a missing lang is ``und``. Repeated rows count as often as they are there. Very
    long texts are sorted in stretches, and their windows cross these. Equal scores come by count, then by the phrase's
    bytes. Other columns are not read; an empty table gives no row.
    """
    folder = workspace(spark, "collocations")
    phrase_counts(spark, documents, folder, least, budget, listed).write.parquet(f"{folder}/phrases")
    phrases = spark.read.parquet(f"{folder}/phrases")
    words, size = spark.read.parquet(f"{folder}/words"), F.size("words")
    candidates = phrases.filter(size >= 2)

    # A phrase inside a longer one of the same count is inside one that is longer by a word, with that count as well.
    inner = F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))
    covering = phrases.filter(size >= 3).select(F.explode(inner).alias("inner"), "f").groupBy("inner").agg(F.max("f").alias("cover"))
    covering.write.parquet(f"{folder}/covering")
    covering = spark.read.parquet(f"{folder}/covering")
    open_ = candidates.join(covering.hint("merge"), F.col("words") == F.col("inner"), "left").filter("cover is null or cover < f")

    cut = F.explode(F.sequence(F.lit(1), size - 1))
    cuts = open_.select("lang", "words", F.col("f").alias("a"), cut.alias("k"))
    cuts = cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k"))).withColumn("tail", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
    known = lambda name, f: phrases.select(F.col("words").alias(name), F.col("f").alias(f)).hint("merge")
    cuts = cuts.join(known("head", "l"), "head").join(known("tail", "r"), "tail")
    words.groupBy("lang").agg(F.sum("n").alias("n")).write.parquet(f"{folder}/totals")
    cuts = cuts.join(spark.read.parquet(f"{folder}/totals"), "lang").withColumn("score", score_of("a", "n", "l", "r"))
    least_cut = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "words", "a", "n").agg(least_cut).select("lang", "words", "a", "n", "cut.score", "cut.l", "cut.r")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    scored.withColumn("place", F.rank().over(best)).filter(F.col("place") <= first).write.parquet(f"{folder}/best")

    named = spark.read.parquet(f"{folder}/best").drop("place")
    texts = named.select("words", F.posexplode("words").alias("at", "name")).join(words.filter(F.col("n") >= least).select("name", "word"), "name")
    texts = texts.groupBy("words").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("parts"))
    named = named.join(texts, "words").withColumn("phrase", F.array_join(F.transform("parts", lambda p: p["word"]), " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def digest(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return collocations(spark, documents)


# Windows of two to five words start at every word; a piece ends at a mark or a line's end.
ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS MATERIALIZED (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), f AS MATERIALIZED (
    SELECT lang, p, count(*) AS f FROM (
        SELECT lang, unnest(flatten(list_transform(range(1, len(w) + 1), lambda i: list_transform(range(i, least(i + 5, len(w) + 1)), lambda j: w[i:j])))) AS p
        FROM words
    ) GROUP BY lang, p HAVING count(*) >= 100
), totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), covered AS (
    SELECT DISTINCT lang, p FROM (SELECT lang, unnest([p[:-2], p[2:]]) AS p, f FROM f WHERE len(p) > 2) JOIN f USING (lang, p, f)
), cuts AS (
    SELECT lang, p, f AS a, unnest(range(1, len(p))) AS k FROM f ANTI JOIN covered USING (lang, p) WHERE len(p) > 1
), scores AS (
    SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
    FROM cuts c JOIN totals t USING (lang) JOIN f l ON l.lang = c.lang AND l.p = c.p[1:c.k] JOIN f r ON r.lang = c.lang AND r.p = c.p[c.k + 1:]
), best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""
