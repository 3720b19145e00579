"""The training-data pipeline: stages over the documents table, each stored and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footfall.llm import jaccard_join, mixing, packing, pii, quality_rules
from footfall.session import materialize

# What a worker's encoder remembers: less than where packing runs alone, as the executors have grown in the stages before.
REMEMBERED = 32 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles link at a similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs, width=5, percent=80, stored=True)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a training sequence."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_quality),
    ("ngram_jaccard_join", without_near_copies),
    ("personal_data", without_personal_data),
    ("mixing", mixed),
    ("packing", packed),
]

# Packing and tagging depend on tokenizers and a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
