"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of vote patterns
estimates how often each rule gives each vote on good and on bad texts; the posterior probability of "good"
takes the place of a filter that every rule must pass. All of it is DataFrame and SQL functions. The pattern
table has 3^rules rows at most, whatever the corpus; only sums over it, one row, come to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import workspace

# Each rule is an SQL expression over the statistics; it reads the same in Spark and in the oracle.
RULES = {
    "symbols": "CASE WHEN 100 * n_symbols > 4 * word_chars THEN -1 WHEN 100 * n_symbols <= word_chars THEN 1 ELSE 0 END",
    "repeats": "CASE WHEN 100 * n_repeat_words > 40 * n_words THEN -1 WHEN 100 * n_repeat_words <= 12 * n_words THEN 1 ELSE 0 END",
    "lines": "CASE WHEN 100 * n_dup_lines > 35 * n_lines THEN -1 WHEN 100 * n_dup_lines <= 20 * n_lines THEN 1 ELSE 0 END",
    "capitals": "CASE WHEN 100 * n_upper > 40 * word_chars THEN -1 WHEN 100 * n_upper <= 10 * word_chars THEN 1 ELSE 0 END",
    "shouts": "CASE WHEN 2 * n_bangs > n_words THEN -1 WHEN 20 * n_bangs <= n_words THEN 1 ELSE 0 END",
    "tables": "CASE WHEN 5 * n_pipes > n_words THEN -1 WHEN 20 * n_pipes <= n_words THEN 1 ELSE 0 END",
    "word_length": "CASE WHEN word_chars > 15 * n_words OR word_chars < 2 * n_words THEN -1 "
    "WHEN word_chars >= 4 * n_words AND 2 * word_chars <= 13 * n_words THEN 1 ELSE 0 END",
}
ROUNDS = 20
VOTES = (-1, 0, 1)
BASE_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules read, of whole texts; a missing text counts as an empty one.

    Repeated windows are found inside the row: windows of three words are hashed, and only where some hash is not
    distinct, sorted with their places, so that equal neighbours give the places that repeat.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    words = kept.select(
        "doc_id",
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).alias("n_symbols"),
        (F.length("text") - F.length(F.regexp_replace("text", r"\p{Lu}", ""))).alias("n_upper"),
        (F.length("text") - F.length(F.replace("text", F.lit("!"), F.lit("")))).alias("n_bangs"),
        (F.length("text") - F.length(F.replace("text", F.lit("|"), F.lit("")))).alias("n_pipes"),
    )
    hashed = words.select(
        "doc_id",
        "n_symbols",
        "n_upper",
        "n_bangs",
        "n_pipes",
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"),
    )
    at = lambda i: F.get(F.col("hashes"), i)
    windows = F.when(
        F.size("hashes") >= 3,
        F.transform(F.sequence(F.lit(0), F.size("hashes") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))),
    ).otherwise(F.array().cast("array<long>"))
    windowed = hashed.withColumn("windows", windows).drop("hashes")
    some_repeat = F.size(F.array_distinct("windows")) < F.size("windows")
    sorted_windows = F.when(
        some_repeat, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    )
    ordered = windowed.withColumn("sorted", sorted_windows).drop("windows")
    near = lambda i: F.get(F.col("sorted"), i)["h"]
    repeated = F.filter("sorted", lambda x, i: (near(i - 1) == x["h"]) | (near(i + 1) == x["h"]))
    marked = ordered.withColumn("places", F.sort_array(F.transform(repeated, lambda x: x["at"]))).drop("sorted")
    # A repeated window covers its three words, less those that the next repeated one covers.
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("places"), i + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda total, n: total + n,
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_upper", "n_bangs", "n_pipes"]
    return marked.select(
        "doc_id", *(F.col(c).cast("long").alias(c) for c in counts), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")
    )


def _posterior(weights: dict[str, float]) -> Column:
    """P(good | votes) from the prior and each rule's vote rates."""

    def joint(side: str) -> Column:
        p = F.lit(weights[side])
        for rule in RULES:
            rates = [F.when(F.col(rule) == vote, F.lit(weights[f"{rule}{vote}{side}"])) for vote in VOTES]
            p = p * F.coalesce(*rates)
        return p

    good, bad = joint("good"), joint("bad")
    return good / (good + bad)


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """Vote rates of every rule on good and bad texts, and the share of good ones.

    ``patterns`` has one column per rule and ``n``. At first a pattern counts as bad if a rule votes bad. Rates are
    smoothed by one text per vote, so that a vote never seen keeps a small rate and empty tables give even rates.
    """
    any_bad = F.lit(False)
    for rule in RULES:
        any_bad = any_bad | (F.col(rule) == -1)
    good = F.when(any_bad, F.lit(0.1)).otherwise(F.lit(0.9))
    weights: dict[str, float] = {}
    for _ in range(rounds):
        shares = patterns.withColumn("good", F.col("n") * good).withColumn("bad", F.col("n") - F.col("good"))
        sums = [F.coalesce(F.sum(side), F.lit(0.0)).alias(side) for side in ("good", "bad")] + [
            F.coalesce(F.sum(F.when(F.col(rule) == vote, F.col(side))), F.lit(0.0)).alias(f"{rule}{vote}{side}")
            for rule in RULES
            for vote in VOTES
            for side in ("good", "bad")
        ]
        found = shares.agg(*sums).first().asDict()
        total = found["good"] + found["bad"] + 2
        weights = {side: (found[side] + 1) / total for side in ("good", "bad")}
        for rule in RULES:
            for side in ("good", "bad"):
                for vote in VOTES:
                    weights[f"{rule}{vote}{side}"] = (found[f"{rule}{vote}{side}"] + 1) / (found[side] + 3)
        good = _posterior(weights)
    return weights


def judged(spark: SparkSession, documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Statistics, votes, ``posterior``, ``base_failed`` and ``kept`` of every document.

    Statistics are written once to the shared folder, as they are read twice. Rows with the same id are judged by
    their own texts. An empty table gives no row; columns other than doc_id and text are not looked at.
    """
    folder = workspace(spark, "quality-rules")
    stats = statistics(documents)
    stats.select("*", *(F.expr(f"cast({rule} as int)").alias(name) for name, rule in RULES.items())).write.parquet(f"{folder}/statistics")
    voted = spark.read.parquet(f"{folder}/statistics")
    voted.groupBy(*RULES).agg(F.count("*").alias("n")).coalesce(1).write.parquet(f"{folder}/patterns")
    weights = estimate(spark.read.parquet(f"{folder}/patterns"))
    scored = voted.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("posterior", _posterior(weights))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def digest(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return judged(spark, documents).select(*RESULT)


def _oracle() -> str:
    """The same in SQL, with the rounds written out."""
    shares = [
        f"coalesce(sum(CASE WHEN {rule} = {vote} THEN {side} ELSE 0 END), 0) AS {rule}_{vote + 1}_{side}"
        for rule in RULES
        for vote in VOTES
        for side in ("good", "bad")
    ]

    def joint(side: str) -> str:
        rates = [
            f"((CASE p.{rule} WHEN -1 THEN m.{rule}_0_{side} WHEN 0 THEN m.{rule}_1_{side} ELSE m.{rule}_2_{side} END) + 1) / (m.{side} + 3)"
            for rule in RULES
        ]
        return " * ".join([f"((m.{side} + 1) / (m.good + m.bad + 2))", *rates])

    any_bad = " OR ".join(f"{rule} = -1" for rule in RULES)
    rounds = [f"e0 AS MATERIALIZED (SELECT *, n * CASE WHEN {any_bad} THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END AS good FROM patterns)"]
    for i in range(ROUNDS):
        rounds.append(
            f"m{i} AS MATERIALIZED (SELECT coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad, {', '.join(shares)} "
            f"FROM (SELECT *, n - good AS bad FROM e{i}))"
        )
        rounds.append(f"e{i + 1} AS MATERIALIZED (SELECT p.*, n * g / (g + b) AS good, g / (g + b) AS posterior FROM "
                      f"(SELECT p.*, {joint('good')} AS g, {joint('bad')} AS b FROM patterns p, m{i} m) p)")  # fmt: skip
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), windows AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM words)
), repeats AS (
    SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows), range(3) AS r(o)
    WHERE n > 1 GROUP BY doc_id
), stats AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words, length(list_aggregate(words, 'string_agg', ''))::BIGINT AS word_chars_,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS n_upper,
           length(text) - length(replace(text, '!', '')) AS n_bangs,
           length(text) - length(replace(text, '|', '')) AS n_pipes, len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM words w LEFT JOIN repeats r ON r.doc_id = w.doc_id
), counted AS (SELECT * EXCLUDE (word_chars_), coalesce(word_chars_, 0) AS word_chars FROM stats),
voted AS MATERIALIZED (SELECT *, {", ".join(f"{rule} AS {name}" for name, rule in RULES.items())} FROM counted),
patterns AS MATERIALIZED (SELECT {", ".join(RULES)}, count(*) AS n FROM voted GROUP BY ALL),
{", ".join(rounds)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
       NOT {BASE_FAILED} AND posterior >= 0.5 AS kept
FROM voted JOIN e{ROUNDS} e USING ({", ".join(RULES)})
"""


ORACLE = _oracle()
