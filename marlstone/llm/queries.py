"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, clustering, exactdup, html, license, linededup, neardup, packing, pii, quality, qualityrules, search, tokenfiles
from .common import table
from .oracles import oracle_sql as oracle_sql


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualityrules.quality_rules(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file; MARLSTONE_TOKENIZERS names another folder than the installed one."""
    folder = os.environ.get("MARLSTONE_TOKENIZERS")
    return f"{folder}/{name}" if folder else public_tokenizers.path(name)


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_bpe_round_trip": op1_bpe_round_trip, "op5_packing": op5_packing, "op2_pii": op2_pii, "op3_minhash_near_dedup": op3_minhash_near_dedup, "op4_quality_rules": op4_quality_rules, "op6_html_main_text": op6_html_main_text, "op7_license_scan": op7_license_scan, "op8_line_dedup": op8_line_dedup, "op9_exact_dedup": op9_exact_dedup, "op10_quality_classifier": op10_quality_classifier, "op11_centroid_clustering": op11_centroid_clustering, "op12_ranked_search": op12_ranked_search, "op13_token_files": op13_token_files}
