"""Error summaries and per-file, per-chunk and per-batch counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colsieve.functions.joins import join_null_safe


def error_summary(df: DataFrame, kind: str, record: str, examples: int = 3) -> DataFrame:
    """Errors per kind with the first few record ids.

    Only ``examples`` ids per kind and task reach the shuffle, however common a kind is.
    """
    order = Window.partitionBy(kind).orderBy(record)
    first = (
        df.select(kind, record).withColumn("_r", F.row_number().over(order))
        .filter(F.col("_r") <= examples)
        .groupBy(kind).agg(F.array_sort(F.collect_list(record)).alias("examples"))
    )
    totals = df.groupBy(kind).agg(F.count("*").alias("n_errors"))
    return join_null_safe(totals, first, [kind])


def outcome_metrics(df: DataFrame, groups: list[str], status: Column) -> DataFrame:
    """Totals, failures, timeouts and the success rate in percent per file or chunk."""
    failed = status.startswith("failed(")
    counted = df.groupBy(*groups).agg(
        F.count("*").alias("n_total"),
        F.count_if(~failed).alias("n_success"),
        F.count_if(failed).alias("n_failed"),
        F.count_if(status == "failed(skip)").alias("n_timeout"),
    )
    return counted.withColumn("success_rate", 100.0 * F.col("n_success") / F.col("n_total"))


def combine_summaries(df: DataFrame, counters: list[str]) -> DataFrame:
    """Add up per-file counters over a batch."""
    return df.agg(F.count("*").alias("n_files"), *[F.sum(c).alias(c) for c in counters])


def missing_chunks(chunks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Chunks that no finished part exists for."""
    return chunks.join(done.select(key).distinct(), key, "left_anti")
