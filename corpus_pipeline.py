"""The corpus pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farewind.llm import decontaminate, language, mixing, near_dups, quality
from farewind.scratch import stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is not told with confidence, go."""
    return language.keep_identified(docs)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail the rules go, and so do documents that fail or lose too much."""
    return quality.keep_good(docs)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: that with the smallest doc_id."""
    return near_dups.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the rate that mixes the domains to target, and drops what is drawn no time."""
    return mixing.draw(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES = [
    ("language", language_stage),
    ("quality", quality_stage),
    ("near_dups", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: No SQL gives the trained language stage or the fitted rates; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
