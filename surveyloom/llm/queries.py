"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from surveyloom.llm import chat_format, license_scan, prefix_trie, url_filter
from surveyloom.llm.bpe_automaton import encoding_digests
from surveyloom.llm.decontaminate import find_leaks
from surveyloom.llm.embedding_whitening import whiten
from surveyloom.llm.html_extract import extract_text
from surveyloom.llm.pii_crf import find_personal_data
from surveyloom.llm.quality_classifier import score_documents
from surveyloom.llm.quality_rules import apply_rules
from surveyloom.llm.simhash import near_duplicates
from surveyloom.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(_table(spark, sf_dir, "documents"))


def op3_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.with_specimen(_table(spark, sf_dir, "conversations"))
    return chat_format.conversation_digests(turns)


def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(_table(spark, sf_dir, "conversations"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_quality_classifier,
        op2_quality_rules,
        op3_pii_crf,
        op4_simhash_dedup,
        op5_token_counts,
        op6_chat_format,
        op7_bpe_automaton,
        op8_license_scan,
        op9_benchmark_decontamination,
        op10_html_extraction,
        op11_embedding_whitening,
        op12_conversation_trie,
        op13_url_filters,
    )
}

ORACLES: dict[str, str] = {
    "op6_chat_format": chat_format.ORACLE,
    "op8_license_scan": license_scan.oracle(),
    "op12_conversation_trie": prefix_trie.ORACLE,
    "op13_url_filters": url_filter.oracle(),
}
