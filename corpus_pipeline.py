"""The corpus pipeline: language ID, line dedup, n-gram Jaccard join, secret scans, best-fit packing.

Every stage but the last returns the columns of its input; a text that a stage changes gets a new n_chars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, line_dedup, ngram_join, packing, secret_scan
from tidemark.session import workspace


def _like(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` of changed rows, with the length of the text as it is now."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no language claims go: those without a letter, and those far from every centroid.

    Where no row has a usable lang, no language is learned, and only those without a letter go.
    """
    return language_id.of_known_language(docs, language_id.fit_on(docs)).select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated passages go, but for their first place; a document goes whose lines have all gone."""
    thinned = line_dedup.dedup_lines(docs, kept_lines="__kept_lines", removed_lines="__removed_lines")
    return _like(docs, thinned.filter("__kept_lines > 0 or __removed_lines = 0"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each(spark, docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out; no document goes."""
    clean = secret_scan.scanned(docs, secret_scan.train_on(docs), spans="__spans", clean="__clean")
    return _like(docs, clean.withColumn("text", F.col("__clean")))


def bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bin and offset of every piece of every document; near copies went before, so that clusters are exact copies."""
    return packing.digest(docs, near=False)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("ngram_join", distinct_documents),
    ("secret_scan", without_secrets),
    ("best_fit_packing", bins),
]
# Trained models decide, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
