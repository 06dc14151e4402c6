"""From raw documents to packed training sequences: five stages, each stored before the next one reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableload.llm.common import stored
from tableload.llm.exact import drop_exact_duplicates
from tableload.llm.jaccard import drop_near_duplicates
from tableload.llm.packing import packed_documents
from tableload.llm.quality import keep_quality
from tableload.llm.toxicity import keep_harmless, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the models learn from the labelled ones."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return keep_harmless(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the thresholds of their language and source go."""
    return keep_quality(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links (five-word shingles, similarity 0.8) connect, the one with the smallest id stays."""
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

ORACLE_SQL = None  # a toxicity model has no SQL; the tests check each stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every earlier one is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
