"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

Every stage takes ``(spark, docs, folder)`` and works on all rows its predecessor kept. All but the
last return rows of ``documents`` with its columns; the last returns the mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from colsieve.llm import decontaminate, language, mixing, near_dup, passages
from colsieve.llm.store import ensure_checkpoint_dir, table


def identified_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is known; texts without a letter go."""
    return language.keep_identified(docs)


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, accepts."""
    return passages.keep_good(docs, table(spark, folder, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.keep_one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.keep_clean(docs, table(spark, folder, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """What the mix takes of every document that is left."""
    return mixing.mix(docs)


STAGES = [
    ("language", identified_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
]

#: Trained models and sketches decide, so SQL can't give the rows; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
