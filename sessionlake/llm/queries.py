"""Queries that apply the operators to whole tables, and the SQL that computes the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlake.llm import (
    byte_bpe,
    exact_dedup,
    language_id,
    lexical,
    mixing,
    ngram_join,
    passages,
    privacy,
    runs,
    sharding,
    token_files,
    topk,
    toxicity,
)
from sessionlake.llm.common import load


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_digest(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.near_duplicate_classes(load(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_privacy(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.span_digest(load(spark, folder, "documents"))


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_file_digest(
        load(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def op5_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(load(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify_digest(load(spark, folder, "documents"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_digest(load(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.duplicate_groups(load(spark, folder, "documents"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(load(spark, folder, "documents"))


def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.round_trip(
        load(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    ).drop("ids")


def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank_documents(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op12_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.passage_digest(load(spark, folder, "documents"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.run_digest(load(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_join": op2_ngram_join,
    "op3_privacy": op3_privacy,
    "op4_token_files": op4_token_files,
    "op5_topk": op5_topk,
    "op6_language_id": op6_language_id,
    "op7_sharding": op7_sharding,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_mixing": op9_mixing,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_lexical": op11_lexical,
    "op12_passages": op12_passages,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op2_ngram_join": ngram_join.ORACLE,
    "op5_topk": topk.ORACLE,
    "op7_sharding": sharding.ORACLE,
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op11_lexical": lexical.ORACLE,
    "op12_passages": passages.ORACLE,
}
