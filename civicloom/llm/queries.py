"""The operators applied to the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from civicloom.llm import (
    embedding_dedup, hard_negatives, html_text, language_id, lexical_search, license_scan, line_dedup, mixing, packing, quality_model, quality_rules, simhash, sql,
    toxicity,
)
from civicloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_source_mixing": op6_source_mixing,
    "op7_language_id": op7_language_id,
    "op8_html_extraction": op8_html_extraction,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_lexical_search": op11_lexical_search,
    "op12_license_scan": op12_license_scan,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL: dict[str, str] = {
    "op2_line_dedup": sql.LINE_DEDUP,
    "op5_quality_rules": sql.QUALITY_RULES,
    "op6_source_mixing": sql.MIXTURE,
    "op11_lexical_search": sql.LEXICAL_SEARCH,
    "op13_hard_negatives": sql.HARD_NEGATIVES,
}
