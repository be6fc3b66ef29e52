"""Bounded, reproducible samples of labelled rows, on which classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.llm.store import remainder_is, small_batches

MOST_CLASSES = 1000


def fraction(key: Column) -> Column:
    """A uniform number in [0, 1) that depends on the key alone."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 11) / float(1 << 53)


def chosen(rows: DataFrame, per_class: int) -> DataFrame:
    """``(doc_id, label, weight)`` of about ``per_class`` ids of each label, all where there are fewer.

    An id with two different labels is left out, as are null ids and labels. ``weight`` is the
    number of labelled ids that each chosen one stands for.
    """
    single = rows.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("most")
    ).filter("label = most").select("doc_id", "label")
    sizes = single.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MOST_CLASSES)
    shares = sizes.select(
        F.col("label").alias("name"), F.least(F.lit(1.0), per_class / F.col("count")).alias("share"))
    return single.join(F.broadcast(shares), F.col("label") == F.col("name")).filter(
        fraction(F.col("doc_id")) < F.col("share")
    ).select("doc_id", "label", (1.0 / F.col("share")).alias("weight"))


def training_texts(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """``(text, label, weight)`` of the chosen ids. Their number is bounded, so they are broadcast."""
    small_batches(docs.sparkSession)
    picked = chosen(labels, per_class)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(picked), "doc_id").select("text", "label", "weight")


def training_labels(labels: DataFrame, column: str, modulus: int, held_out: int) -> DataFrame:
    """``(doc_id, label)`` of the rows whose crc32 remainder isn't that of the held-out fold."""
    doc_id = F.col("doc_id").cast("long")
    return labels.filter(~remainder_is(F.col("doc_id"), modulus, held_out)).select(
        doc_id.alias("doc_id"), F.col(column).alias("label"))
