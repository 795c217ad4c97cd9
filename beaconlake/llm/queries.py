"""One registered query per operator: each runs it over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup, kd_sharding, line_dedup, mixing, near_dedup, packing, personal_data, prefix_trie,
    quality_rules, secret_scans, substring_dedup, token_alignment, toxicity,
)
from .common import conversations, documents, labels


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.train(docs, labels(spark, sf_dir)))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_sharding.shards(documents(spark, sf_dir), count=8)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir), labels(spark, sf_dir))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scanned(documents(spark, sf_dir))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.scanned(documents(spark, sf_dir))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(conversations(spark, sf_dir))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_toxicity": op3_toxicity,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_kd_sharding": op6_kd_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_secret_scans": op8_secret_scans,
    "op9_personal_data": op9_personal_data,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_dedup": op13_line_dedup,
}

ORACLE: dict[str, str] = {
    "op4_substring_dedup": substring_dedup.ORACLE_SQL,
    "op5_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_minhash_near_dedup": near_dedup.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_line_dedup": line_dedup.ORACLE_SQL,
}
