"""The queries op1 to op10 over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ball_tree, exact_dedup, html_text, line_dedup, mixing, ngram_join, pii, quality, sentencepiece_trie, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key="key")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"), url_filter.rules_table(spark, url_filter.RULES))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), words=3, percent=90)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_trie.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), sentencepiece_trie.MODEL)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_line_dedup, op2_pii_pseudonyms, op3_top_k, op4_exact_dedup, op5_quality, op6_url_filter, op7_ngram_join, op8_html_text, op9_mix_sources, op10_sentencepiece)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_top_k": ball_tree.ORACLE, "op4_exact_dedup": exact_dedup.ORACLE, "op6_url_filter": url_filter.ORACLE, "op9_mix_sources": mixing.ORACLE}
