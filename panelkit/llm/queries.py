"""The registered queries of this subpackage, each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree, bpe, exact_dedup, huffman_ids, language_id, mih_search, mixing, passages, prefix_trie, quality_rules, simhash, toxicity, weak_quality
from .common import documents, table
from .oracle_sql import ORACLE_SQL  # noqa: F401


def op1_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman_ids.written_and_read(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.quality(documents(spark, sf_dir))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(documents(spark, sf_dir)).drop("key")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(documents(spark, sf_dir))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(documents(spark, sf_dir))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.ranked(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_id_output, op2_language_id, op3_exact_top_k, op4_quality_classifier, op5_simhash_near_dedup,
        op6_byte_level_bpe, op7_mixing_sources, op8_toxicity, op9_quality_rules, op10_suffix_array_dedup, op11_exact_dedup, op12_ranked_search, op13_prefix_trie)
}
