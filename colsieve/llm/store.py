"""Tables between jobs, written to the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from colsieve.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["cut_lineage", "ensure_checkpoint_dir", "small_batches", "table", "remainder_is", "unused"]

BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """From now on at most ``BATCH_ROWS`` rows go to a Python worker at once, as texts may be long."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = int(spark.conf.get(setting))
    if given <= 0 or given > BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder_is(key: Column, modulus: int, value: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus == value, F.lit(False))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex}"
