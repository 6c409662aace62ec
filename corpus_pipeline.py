"""From raw documents to token ids: five stages, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import bpe, decontamination, near_duplicates, quality_rules, toxicity
from spanlake.llm.common import load, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the clause grammar, fitted on the labels, does not call toxic."""
    return toxicity.keep_civil(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, nor one with other names and numbers."""
    return decontamination.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and how many there are."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs.select("doc_id", "text", "lang", "source"), ranks)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", civil),
    ("quality_rules", good),
    ("near_duplicates", different),
    ("decontamination", clean),
    ("bpe", tokens),
]

# Neither the fitted grammar nor the merges of the tokeniser can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = written(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
