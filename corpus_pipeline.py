"""A training corpus from raw documents: five stages, each on all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm.decontaminate import decontaminate
from shoptide.llm.linededup import dedup_lines
from shoptide.llm.nearcopies import drop_near_duplicates
from shoptide.llm.queries import packed_digest
from shoptide.llm.shared import narrow_batches, settle
from shoptide.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of severity grade 1 and more go. The model learns from the labels of what came in."""
    narrow_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, train(docs, labels, F.col("toxic")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one within one edited word go, and documents that had nothing else."""
    narrow_batches(spark)
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays."""
    narrow_batches(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    narrow_batches(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as pieces of full sequences, with every sequence holding the sources in their proportions."""
    narrow_batches(spark)
    return packed_digest(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Regression, similarity joins and tokenizers have no form in SQL; the stages are tested against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
