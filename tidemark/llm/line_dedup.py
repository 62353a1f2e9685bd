"""Line dedup by overlapping windows of three lines.

Consecutive lines of a text that hold a character other than white space form windows; lines without one are
neither counted nor removed. A window that occurs in several places keeps its first occurrence (by document,
then position); every line that a later occurrence covers goes. Covered positions of overlapping windows merge.
Texts with fewer lines than a window have none and stay. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.skew import join_aggregate

WINDOW = 3
BLANK = r"[^\x20\x09-\x0D]"


def _filled_lines(text: Column) -> Column:
    """Lines with a character, each with its number in the text from 0."""
    numbered = F.transform(F.split(text, "\n"), lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(BLANK))


def _windows(documents: DataFrame, window: int) -> DataFrame:
    """One row per window: its two hashes, its document and the place of its first line among filled lines.

    Two 64-bit hashes over the lines, so that different windows do not meet even among 10^13 of them.
    """
    filled = F.filter(F.split("text", "\n"), lambda x: x.rlike(BLANK))
    lines = documents.select(
        "id",
        "version",
        F.transform(filled, lambda x: F.xxhash64(x)).alias("a"),
        F.transform(filled, lambda x: F.xxhash64(F.lit(7), x)).alias("b"),
    )
    lines = lines.filter(F.size("a") >= window)
    starts = F.sequence(F.lit(0), F.size("a") - window)
    placed = lines.select("id", "version", "a", "b", F.explode(starts).alias("at"))
    return placed.select(
        "id",
        "version",
        "at",
        F.xxhash64(F.slice("a", F.col("at") + 1, window)).alias("a"),
        F.xxhash64(F.slice("b", F.col("at") + 1, window)).alias("b"),
    )


def covered_lines(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, version, covered): for each text with a later occurrence, the sorted places of its covered lines.

    ``documents`` has id, version and text. The first place of each window comes from a minimum, which is
    combined before its shuffle; the join back is one that Spark can split where a window is very common.
    """
    windows = _windows(documents, window)
    first = (
        windows.groupBy("a", "b")
        .agg(F.min(F.struct("id", "version", "at")).alias("first"), F.max(F.struct("id", "version", "at")).alias("last"))
        .filter(~F.col("first").eqNullSafe(F.col("last")))
        .select("a", "b", "first")
    )
    later = join_aggregate(windows, first, "a", "b").filter(~F.struct("id", "version", "at").eqNullSafe(F.col("first")))
    # One text's places at most, thinned to distinct ones by the set.
    starts = later.groupBy("id", "version").agg(F.collect_set("at").alias("starts"))
    spread = F.flatten(F.transform("starts", lambda at: F.sequence(at, at + (window - 1))))
    return starts.select("id", "version", F.array_sort(F.array_distinct(spread)).alias("covered"))


def dedup_lines(documents: DataFrame, window: int = WINDOW, kept_lines: str = "kept_lines", removed_lines: str = "removed_lines") -> DataFrame:
    """``documents`` with the text less its covered lines, and how many filled lines stayed and went.

    Missing texts stay missing, empty ones empty. Rows with the same id and text are one document and get the
    same text; rows with one id and different texts are told apart by a hash of the text. A text whose lines are
    all covered becomes empty, and its row stays. Other columns pass through; the two counts replace columns
    of their names.
    """
    keyed = documents.withColumn("__version", F.xxhash64("text"))
    covered = covered_lines(keyed.select(F.col("doc_id").alias("id"), F.col("__version").alias("version"), "text"), window)
    covered = covered.select(F.col("id").alias("__id"), F.col("version").alias("__of"), F.col("covered").alias("__covered"))
    joined = keyed.join(covered, keyed["doc_id"].eqNullSafe(F.col("__id")) & (keyed["__version"] == F.col("__of")), "left")
    filled = joined.withColumn("__filled", F.when(F.col("__covered").isNotNull(), _filled_lines(F.col("text"))))
    # Numbers in the text of the lines that go; a map, so that each line is looked up once.
    gone = filled.withColumn("__gone", F.transform("__covered", lambda at: F.element_at(F.col("__filled"), at + 1)["at"]))
    gone = gone.withColumn("__lines", F.when(F.col("__covered").isNotNull(), F.split("text", "\n")))
    kept = F.array_join(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone")),
            lambda i: F.get(F.col("__lines"), i),
        ),
        "\n",
    )
    n_filled = F.when(F.col("text").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.split("text", "\n"), lambda x: x.rlike(BLANK)))
    )
    n_gone = F.coalesce(F.size("__covered"), F.lit(0))
    out = gone.withColumn("__n", n_filled).withColumn("__went", F.when(F.col("__covered").isNull(), F.lit(0)).otherwise(n_gone))
    out = out.withColumn("text", F.when(F.col("__covered").isNull(), F.col("text")).otherwise(kept))
    out = out.withColumn(kept_lines, (F.col("__n") - F.col("__went")).cast("long")).withColumn(removed_lines, F.col("__went").cast("long"))
    return out.drop("__version", "__id", "__of", "__covered", "__filled", "__gone", "__lines", "__n", "__went")


def digest(documents: DataFrame) -> DataFrame:
    """doc_id, lines kept and removed, length and hash of the text that stays."""
    cleaned = dedup_lines(documents.select("doc_id", "text"))
    return cleaned.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "kept_lines",
        "removed_lines",
        F.length("text").cast("long").alias("n_chars"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


ORACLE = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS nr
    FROM documents WHERE text IS NOT NULL
), filled AS (
    SELECT doc_id, nr, line, row_number() OVER (PARTITION BY doc_id ORDER BY nr) - 1 AS place
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), windows AS (
    SELECT doc_id, place, line AS l0, lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2
    FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), ranked AS (
    SELECT doc_id, place, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, place) AS nth
    FROM windows WHERE l2 IS NOT NULL
), covered AS (
    SELECT DISTINCT doc_id, place + o AS place FROM ranked, range(3) AS r(o) WHERE nth > 1
), marked AS (
    SELECT l.doc_id, l.nr, l.line, f.place IS NOT NULL AS is_filled, c.place IS NOT NULL AS gone
    FROM lines l LEFT JOIN filled f ON f.doc_id = l.doc_id AND f.nr = l.nr
    LEFT JOIN covered c ON c.doc_id = f.doc_id AND c.place = f.place
), texts AS (
    SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (WHERE NOT gone), '') AS text,
           count(*) FILTER (WHERE is_filled AND NOT gone) AS kept_lines, count(*) FILTER (WHERE gone) AS removed_lines
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(t.kept_lines, 0) AS kept_lines, coalesce(t.removed_lines, 0) AS removed_lines,
       length(t.text) AS n_chars, md5(t.text) AS text_md5
FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id
"""
