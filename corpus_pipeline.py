"""The corpus pipeline: each stage works on all rows that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import decontamination, entries, near_duplicates, pii, quality_classifier, sentencepiece_codec, tools


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    stats = tools.staged(quality_classifier.statistics_of(docs), "stats")
    model = quality_classifier.train(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return near_duplicates.keep_one(docs, 5, 80, 100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, and whether decoding gives the text back."""
    rows = sentencepiece_codec.encoded(docs, entries.MODEL_PATH)
    return rows.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact),
    ("sentencepiece_codec", tokenize),
]

#: No SQL can express the first stage, a trained model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = tools.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
