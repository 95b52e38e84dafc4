"""From raw documents to a training mix: five stages, each of which works on all its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from assayflow.llm import budget, covering, decontaminate, lines, quality
from assayflow.sources.tables import shared_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.7 go. Fitted on the documents given and the labels of theirs."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and similar lines the first stays; texts change, no document goes."""
    return lines.drop_lines(docs, length="n_chars")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return covering.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies``, how often each is taken."""
    return budget.take_mix(docs)


STAGES = [("quality", quality_stage), ("lines", lines_stage), ("near_duplicates", near_duplicates_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage)]

#: Neither the classifier nor the components nor the knapsack can be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
