"""A corpus from raw documents to packed sequences: quality, near duplicates, repeated passages, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltbed.llm.common import written
from siltbed.llm.mixing import mixed_documents
from siltbed.llm.near_dedup import drop_near_duplicates
from siltbed.llm.packing import pack
from siltbed.llm.quality_rules import drop_anomalous
from siltbed.llm.queries import TARGETS, domain_labels, tokenizer
from siltbed.llm.repeats import without_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the isolation forest keep."""
    return drop_anomalous(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more)."""
    return drop_near_duplicates(spark, docs, threshold=0.8, width=5)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that a document with a smaller id has too."""
    return without_repeats(spark, docs, length=50, chars_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of languages asks for, each at least once."""
    labels = domain_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return mixed_documents(spark, docs, labels, TARGETS, tokenizer(), floor=1.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return pack(docs, tokenizer(), capacity=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL cannot express the forest, the mix and the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return docs
