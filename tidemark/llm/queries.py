"""The queries of the subpackage, each over its whole tables, and SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    collocations,
    embedding_dedup,
    hard_negatives,
    language_id,
    line_dedup,
    ngram_join,
    packing,
    pieces,
    quality_gam,
    quality_rules,
    secret_scan,
    sharding,
    token_counts,
)


TOKENIZERS = "/opt/tokenizers"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.digest(spark, _table(spark, folder, "documents"))


def op2_sentencepiece(spark: SparkSession, folder: str, model_file: str = f"{TOKENIZERS}/piece_bpe_32k.model") -> DataFrame:
    return pieces.digest(_table(spark, folder, "documents"), model_file)


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.placed(_table(spark, folder, "documents"))


def op4_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.digest(spark, _table(spark, folder, "embeddings"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(_table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.digest(_table(spark, folder, "documents"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(_table(spark, folder, "documents"))


def op8_token_counts(spark: SparkSession, folder: str, rank_file: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    return token_counts.digest(spark, _table(spark, folder, "documents"), rank_file)


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(_table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.digest(spark, _table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.digest(spark, _table(spark, folder, "documents"))


def op12_quality_gam(spark: SparkSession, folder: str) -> DataFrame:
    return quality_gam.digest(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.digest(spark, _table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_ngram_join,
        op2_sentencepiece,
        op3_sharding,
        op4_embedding_dedup,
        op5_secret_scan,
        op6_language_id,
        op7_best_fit_packing,
        op8_token_counts,
        op9_line_dedup,
        op10_quality_rules,
        op11_collocations,
        op12_quality_gam,
        op13_hard_negatives,
    )
}

ORACLES = {
    "op4_embedding_dedup": embedding_dedup.ORACLE,
    "op9_line_dedup": line_dedup.ORACLE,
    "op10_quality_rules": quality_rules.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
