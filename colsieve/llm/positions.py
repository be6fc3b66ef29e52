"""Places of rows in the order of their group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colsieve.llm.store import cut_lineage


def numbered(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds ``position``, from 0 in each group of the non-null ``keys``, and ``n``, the group's rows.

    Rows are dealt by range of keys and order, so a large group takes many tasks; each task numbers
    what it holds and only a count per task and group goes further. Rows equal in keys and order
    are spread by where they were read; which of them comes first is open.
    """
    by = [*[F.col(k) for k in keys], *order, F.col("_read")]
    dealt = df.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    held = cut_lineage(dealt.drop("_read").select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")))
    counts = held.groupBy(*keys, "_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_held"))
    group = Window.partitionBy(*keys)
    before = F.sum("_held").over(group.orderBy("_part")) - F.col("_held")
    offsets = counts.select(*keys, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_held").over(group).alias("n"))
    return held.join(offsets, [*keys, "_part"]).withColumn("position", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")
