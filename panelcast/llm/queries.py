"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import (
    hamming_search, html, licenses, maxent_lm, mixing, ngram_join, periodic_runs, pieces, quality, sharding, simhash, toxicity, zone_kmeans)
from panelcast.llm.common import read_table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op1_query(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.op2_query(spark, read_table(spark, sf_dir, "pages"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op3_query(spark, read_table(spark, sf_dir, "documents"))


def op4_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.op4_query(spark, read_table(spark, sf_dir, "embeddings"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op5_query(spark, read_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.op6_query(spark, read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op7_query(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.op8_query(spark, read_table(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op9_query(spark, read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op10_query(spark, read_table(spark, sf_dir, "documents"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.op11_query(spark, read_table(spark, sf_dir, "documents"))


def op12_zone_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_kmeans.op12_query(spark, read_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.op13_query(spark, read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mixing, op2_html_extraction, op3_license_scan, op4_hamming_search, op5_quality_rules, op6_lm_scoring, op7_toxicity, op8_piece_encoding, op9_simhash_dedup,
        op10_sharding, op11_ngram_join, op12_zone_kmeans, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": licenses.oracle_sql(), "op4_hamming_search": hamming_search.oracle_sql(),
            "op12_zone_kmeans": zone_kmeans.oracle_sql()}
