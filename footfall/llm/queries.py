"""The operators applied to the whole given tables: ``opN_<name>(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import attribution, fixity, hilbert, html_text, jaccard_join, lexical_search, mixing, packing, pii
from footfall.llm import prefix_trie, quality_rules, spotsigs, token_files
from footfall.llm.common import documents
from footfall.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_pareto_mix(spark, sf_dir):
    return mixing.report(documents(spark, sf_dir))


@query
def op2_spotsigs(spark, sf_dir):
    return spotsigs.report(documents(spark, sf_dir))


@query
def op3_zstd_token_files(spark, sf_dir):
    return token_files.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_token_attribution(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return attribution.attributed(documents(spark, sf_dir), path, ("source", "lang", "text"))


@query
def op5_best_fit_packing(spark, sf_dir):
    return packing.packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_semi_markov_pii(spark, sf_dir):
    return pii.report(documents(spark, sf_dir))


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules.report(documents(spark, sf_dir))


@query
def op6_ngram_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(documents(spark, sf_dir), width=3, percent=90).drop("set")


@query
def op8_hilbert_shards(spark, sf_dir):
    return hilbert.report(documents(spark, sf_dir))


@query
def op10_merkle_fixity(spark, sf_dir):
    """Audit of all pages against a replica with known damage: changed, lost and added records."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    changed = F.when(F.col("page_id") % 97 == 13, F.concat(F.lit("#"), F.col("html"))).otherwise(F.col("html"))
    copy = pages.where(F.expr("coalesce(page_id % 211 != 5, TRUE)")).withColumn("html", changed)
    added = pages.where("page_id % 503 = 7").withColumn("page_id", -F.col("page_id"))
    found = fixity.audit(fixity.leaves(pages), fixity.leaves(copy.unionByName(added)))
    return found.withColumnRenamed("key", "page_id").withColumnRenamed("id", "record_id")


@query
def op11_html_text(spark, sf_dir):
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op13_lexical_search(spark, sf_dir):
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
