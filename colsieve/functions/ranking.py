"""Row numbers within groups that stay parallel when one group is very large."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colsieve.functions.joins import join_null_safe

SLICE_ROWS = 100_000


def with_slices(df: DataFrame, columns: list[str], names: list[str], count: int) -> DataFrame:
    """Add, per numeric column, the number of the value range it falls in.

    Ranges follow the approximate quantiles, so they hold about equally many rows however
    the values cluster; equal values always share a range.
    """
    grid = ", ".join(f"{i / count!r}D" for i in range(1, count))  # as text: thousands of literals
    row = df.agg(*[
        F.expr(f"percentile_approx(cast(`{c}` as double), array({grid}), {max(10_000, 4 * count)})").alias(c)
        for c in columns
    ]).first()  # one row of count - 1 split points per column
    splits = [[-math.inf, *sorted(set(row[c] or [0.0])), math.inf] for c in columns]
    sliced = Bucketizer(
        splitsArray=splits, inputCols=columns, outputCols=names, handleInvalid="keep"
    ).transform(df)
    return sliced.withColumns({n: F.col(n).cast("int") for n in names})


def with_group_rank(
    df: DataFrame, groups: list[str], order: str, rank: str = "group_rank", slices: int | None = None
) -> DataFrame:
    """``row_number() over (partition by groups order by order)`` for a numeric ``order``.

    Each group is cut into slices of ``order``; rows are numbered inside a slice and shifted
    by the sizes of the slices before, so a group holding a third of all rows is still spread
    over many tasks. Their number follows the rows, one per ``SLICE_ROWS``, unless given.
    """
    if slices is None:
        slices = max(2, math.ceil(df.count() / SLICE_ROWS))
    sliced = with_slices(df, [order], ["_slice"], slices)
    sizes = sliced.groupBy(*groups, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        *groups, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(*groups, "_slice").orderBy(order)
    numbered = sliced.withColumn("_at", F.row_number().over(within))
    return (
        join_null_safe(numbered, offsets, [*groups, "_slice"])
        .withColumn(rank, F.col("_before") + F.col("_at"))
        .drop("_slice", "_before", "_at")
    )
