"""The corpus pipeline: documents through five of the text operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.llm import contamination, mixing, neardup, quality, sharding
from wattline.llm.common import table
from wattline.session import fresh_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, similarity 0.8)."""
    return neardup.near_unique(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shards."""
    return sharding.with_shards(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("near duplicates", near_unique),
    ("benchmark decontamination", decontaminated),
    ("source mixing", mixed),
    ("sharding", sharded),
]

# The classifier and the near duplicates can't be expressed in SQL; tests/llm/test_pipeline.py has a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = fresh_dir(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
