"""Mean ranks of every cell of a wide table in two shuffles, whatever the number of columns."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colsieve.session import cut_lineage

SLICE_ROWS = 100_000  # cells that one task orders
HEAVY = 1000  # a value with more than one in so many rows of its column gets a slice of its own
SALTS = 1024  # parts of a slice that holds one value


def _splits(row: list[float] | None, heavy: int) -> list[float]:
    """Range limits from quantiles; a value that fills several of them is alone in its range."""
    found = Counter(row or [0.0])
    alone = [float(np.nextafter(v, math.inf)) for v, k in found.items() if k > heavy and v < 1.7e308]
    return [-math.inf, *sorted({*found, *alone} - {math.inf, -math.inf}), math.inf]


def mean_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """1-based mean rank of each value in its column, one array a row: ``(ranks)``.

    Rows with a gap take no part; equal values share their mean rank; an empty table gives no row.
    Cells are dealt by (column, range of values), ordered there, and come back by row. A value
    that many rows share has a range of its own, whose rank is known from its size, and its cells
    are dealt to ``SALTS`` parts.
    """
    cells = [(F.col(f"`{c}`").cast("double") + 0.0).alias(f"v{k}") for k, c in enumerate(columns)]  # -0.0 is 0.0
    names, slots = [f"v{k}" for k in range(len(columns))], [f"s{k}" for k in range(len(columns))]
    # Written, so that row numbers stay what they are if a task runs again.
    whole = cut_lineage(df.select(*cells).na.drop().withColumn("row", F.monotonically_increasing_id()))
    count = max(2, math.ceil(whole.count() / SLICE_ROWS))
    grid = ", ".join(f"{k / count!r}D" for k in range(1, count))  # as text: thousands of literals
    points = whole.agg(*[
        F.expr(f"percentile_approx({c}, array({grid}), {max(10_000, 4 * count)})").alias(c) for c in names
    ]).first()  # one row of count - 1 points per column
    sliced = Bucketizer(
        splitsArray=[_splits(points[c], count // HEAVY) for c in names], inputCols=names, outputCols=slots,
        handleInvalid="keep",
    ).transform(whole)
    long = sliced.select("row", F.posexplode(F.array(*[
        F.struct(F.col(s).cast("int").alias("slice"), F.col(v).alias("value")) for v, s in zip(names, slots, strict=True)
    ])).alias("pos", "cell")).select("row", "pos", "cell.slice", "cell.value")
    sizes = long.groupBy("pos", "slice").agg(
        F.count("*").alias("n"), (F.min("value") == F.max("value")).alias("alone"))
    upto = Window.partitionBy("pos").orderBy("slice")  # one row per slice
    placed = cut_lineage(sizes.withColumn("first", F.sum("n").over(upto) - F.col("n")))
    salt = F.when(F.col("alone"), F.pmod(F.xxhash64("row"), F.lit(SALTS))).otherwise(0)
    dealt = long.join(placed, ["pos", "slice"]).withColumn("salt", salt)
    inside = Window.partitionBy("pos", "slice", "salt").orderBy("value")
    equal = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # The mean of the first and the last rank among equal values.
    own = F.when(F.col("alone"), (F.col("n") + 1) / 2).otherwise((F.rank().over(inside) + F.count("*").over(equal)) / 2)
    ranked = dealt.select("row", "pos", (F.col("first") + own).alias("rank"))
    by_row = ranked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "rank"))).alias("cells"))
    return by_row.select(F.col("cells.rank").alias("ranks"))  # one cell per column
