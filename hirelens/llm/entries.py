"""One query for each operator of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import (
    decontamination, html_extraction, lexical_search, near_duplicates, pii, prefix_trie, quality_classifier, quality_rules, secrets, sentencepiece_codec, sharding, substring_dedup,
    suffix_dedup, tools,
)
from hirelens.llm.oracle import ORACLE_SQL  # noqa: F401

#: The model that the codec query encodes with; a parameter of the operator.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(_table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_table(spark, sf_dir, "documents"))


def op3_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sentencepiece_codec.encoded(_table(spark, sf_dir, "documents").select("doc_id", "text"), MODEL_PATH)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip", "parity")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), 3, 85, 100).drop("text_key")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_key")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(_table(spark, sf_dir, "documents")).drop("kept")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = tools.staged(quality_classifier.statistics_of(_table(spark, sf_dir, "documents")), "stats")
    return quality_classifier.score(stats, quality_classifier.train(stats, _table(spark, sf_dir, "labels")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(_table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 20)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(_table(spark, sf_dir, "documents"), 20).drop("kept")


_ALL = (
    op1_html_extraction, op2_quality_rules, op3_sentencepiece_codec, op4_minhash_near_dedup, op5_benchmark_decontamination,
    op6_suffix_dedup, op7_pii, op8_sharding, op9_secret_scan, op10_quality_classifier,
    op11_prefix_trie, op12_lexical_search, op13_substring_dedup,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
