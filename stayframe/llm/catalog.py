"""Queries of the training-data operators: each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, decontaminate, languages, licenses, nearcopies, packing, quality, quotes, repeats, rules, sharding, toxicity, trie
from .tables import read, ship_code


def op1_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return nearcopies.near_copy_groups(read(spark, sf_dir, "documents"), shingle_words=4)


def op3_chat_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(read(spark, sf_dir, "conversations"))


def op4_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return repeats.repeat_digests(read(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return licenses.license_scan(read(spark, sf_dir, "documents"))


def op7_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(read(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return alignment.alignment_digests(read(spark, sf_dir, "documents"))


def op12_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return languages.languages(read(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_code(spark)
    return trie.shared_trie(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_maglev_sharding, op2_minhash_near_dedup, op3_chat_quote_linking, op4_quality_ftrl, op5_suffix_array_dedup,
        op6_license_scan, op7_toxicity_neighbours, op8_best_fit_packing, op9_quality_rules, op10_benchmark_decontamination, op11_token_alignment,
        op12_language_filters, op13_conversation_trie)
}

ORACLES: dict[str, str] = {
    "op1_maglev_sharding": sharding.ORACLE,
    "op3_chat_quote_linking": quotes.ORACLE,
    "op9_quality_rules": rules.ORACLE,
    "op13_conversation_trie": trie.ORACLE,
}
