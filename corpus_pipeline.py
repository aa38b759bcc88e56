"""The corpus pipeline: quality, exact copies, near copies, contamination, packing.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the rows of
``docs`` they keep, with their columns; the last returns packed pieces. Every
stage's result is written as Parquet in the shared folder and read back as the
next one's documents, so a lost executor never costs more than a stage.

The stages' own rules for null texts, repeated rows, empty tables and extra
columns hold (see the operators in ``laketide.llm``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laketide.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from laketide.llm.common import written
from laketide.session import shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal texts."""
    return exact_dedup.first_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts (five words, 0.8 or more)."""
    return jaccard_join.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_duplicates),
          ("n-gram Jaccard join", near_duplicates), ("benchmark decontamination", benchmark_decontamination),
          ("packing", pack)]

# A trained classifier decides the first stage: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
