"""From raw documents to token ids: five stages, each over all that the one before kept.

Every stage takes tables with nulls in any column, empty and very long texts, repeated rows and ids,
no rows at all, and further columns of any name; its docstring says what becomes of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sessionlake.llm import byte_bpe, exact_dedup, mixing, ngram_join, toxicity
from sessionlake.llm.common import load
from sessionlake.session import intermediates_removed, new_folder


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that classifiers, fitted on the labels of rows that aren't held out, reject go.

    Null and empty texts score as texts without any feature do, and equal texts alike; without a
    toxic example all documents stay.
    """
    model = toxicity.train(
        toxicity.learnable(docs), toxicity.learnable(load(spark, sf_dir, "labels"))
    )
    return toxicity.drop_toxic(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the longest one stays; of those the one
    with the smallest id, null last, and of rows equal in all that any one.

    Null, empty and blank texts are equal.
    """
    return exact_dedup.drop_duplicates(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the document with the smallest id stays, null last; of several rows of
    that id one.

    Null, empty and blank texts are near nothing and stay.
    """
    return ngram_join.keep_one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in rows of their own.

    A null source is a source. Rows of one id, or without one, are documents of their own. Null,
    empty and blank texts have no size: they fit any target and go by their place.
    """
    return mixing.mixed(docs)


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, with their digest and that of the decoded text.

    Null and empty texts have no ids; every row gives a row.
    """
    return byte_bpe.round_trip(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_join", ngram_join_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", byte_bpe_stage),
]

# Learning, connected components and tokenisation are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and what a stage has
    written on its way is removed when it ends."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        with intermediates_removed(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
