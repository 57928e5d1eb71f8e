"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from souk.llm import alignment, divergence, html_blocks, langid, line_dedup, mixing, perm_index, pieces, pq_dedup, simhash, subword, suffix_dedup, url_rules
from souk.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_rules.judge(pages, url_rules.labelled_urls(pages, table(spark, sf_dir, "labels")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perm_index.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), n=3)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(table(spark, sf_dir, "documents"), min_docs=10)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"), length=200)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(table(spark, sf_dir, "documents"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subword.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_url_filters": op1_url_filters,
    "op2_html_extraction": op2_html_extraction,
    "op3_source_mixing": op3_source_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_language_id": op10_language_id,
    "op11_source_divergence": op11_source_divergence,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_quality_classifier": op13_quality_classifier,
}
ORACLES: dict[str, str] = {
    "op3_source_mixing": mixing.ORACLE,
    "op8_line_dedup": line_dedup.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
}
