"""Registered queries of the training-data operators.

Each ``opN_*`` applies its operator with production parameters to its whole
table; ``LLM_SQL`` has the DuckDB counterpart where SQL can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    burst_trie,
    decontam,
    divergence,
    langid,
    licenses,
    mixing,
    neardup,
    orc_tokens,
    pii,
    pitman_yor,
    quality,
    substrings,
    urls,
)
from strata.llm.common import table, words
from strata.llm.oracle import LLM_SQL

# The filter rules of op10.
URL_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.predict(docs, langid.learn(docs))


def op4_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.take(docs).select("doc_id", "size", "source_size", "target", "copies", "taken")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.report(docs, pii.learn(docs))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules)


def spam_urls(pages: DataFrame) -> DataFrame:
    """URLs of pages whose title repeats one or two words eight times or more."""
    title = words(F.regexp_extract(F.col("html"), r"<title>([^<]*)</title>", 1))
    return pages.where((F.size(title) >= 8) & (F.size(F.array_distinct(title)) <= 2)).select("url")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    listed = urls.rule_list(spark, URL_RULES).unionByName(urls.listed_pages(spam_urls(pages)))
    return urls.judge(pages, listed).drop("url")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return orc_tokens.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    seqs = burst_trie.sequences(table(spark, sf_dir, "conversations"))
    return burst_trie.trie(burst_trie.shared_openings(seqs))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_lm_scores": op1_lm_scores,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_mixture": op4_mixture,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_licenses": op6_licenses,
    "op7_personal_data": op7_personal_data,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality_rules": op9_quality_rules,
    "op10_url_filter": op10_url_filter,
    "op11_token_files": op11_token_files,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_source_divergence": op13_source_divergence,
}

__all__ = ["LLM_QUERIES", "LLM_SQL"]
