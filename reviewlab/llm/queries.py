"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlab.llm import (decontamination, fingerprints, html_text, jaccard_join, language_id, merkle_manifest, mixing,
                           nn_descent, oracle, prefix_trie, substring_dedup, token_files, toxicity, url_rules)
from reviewlab.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample(table(spark, sf_dir, "documents"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.verdicts(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digest(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.audit(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_token_files": op2_token_files,
    "op3_source_mixing": op3_source_mixing,
    "op4_nn_descent": op4_nn_descent,
    "op5_html_text": op5_html_text,
    "op6_toxicity": op6_toxicity,
    "op7_url_rules": op7_url_rules,
    "op8_language_id": op8_language_id,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_fingerprints": op12_fingerprints,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL = oracle.SQL
