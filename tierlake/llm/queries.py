"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierlake.llm import (
    bpe_automaton,
    conversation_repair,
    fingerprints,
    html_extraction,
    license_scan,
    mixing,
    near_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    token_alignment,
    token_counts,
)

# Parameters of the queries: tokenizer files stay where the installed package has them.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_PIECES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; Python workers of the session find this package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rule_report(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.train(docs, table(spark, sf_dir, "labels")))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_PIECES)


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group_documents(table(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op10_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_and_decode(table(spark, sf_dir, "documents"), WORD_BPE)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"), BYTE_PIECES, PIECES)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extract(pages, html_extraction.learn(pages))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_quality_rules, op2_license_scan, op3_secret_scan, op4_quality_classifier, op5_source_mix,
        op6_packing, op7_token_counts, op8_near_dedup, op9_fingerprints, op10_bpe_automaton,
        op11_conversation_repair, op12_token_alignment, op13_html_extraction,
    ]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.REPORT_SQL,
        "op2_license_scan": license_scan.REPORT_SQL,
        "op5_source_mix": mixing.REPORT_SQL,
    }
