"""Sums of cross products over all rows, accumulated per task and added up by Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes a task may hold as accumulators, and rows x columns x features per inner step.
STATE_BYTES = 512 << 20
STEP_CELLS = 4_000_000
TASKS_PER_CORE = 2

PARTIAL = "block int, i int, vec array<double>"


def matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """A record batch as float64 rows; NULL is NaN."""
    parts = [
        batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
        for c in columns
    ]
    return np.column_stack(parts).astype(np.float64, copy=False)


def as_partials(blocks: Iterable[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Matrices, one per block, as one record per (block, row)."""
    for b, block in enumerate(blocks):
        rows = len(block)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(rows, b, dtype=np.int32)),
                pa.array(np.arange(rows, dtype=np.int32)),
                pa.array(list(block), type=pa.list_(pa.float64())),
            ],
            names=["block", "i", "vec"],
        )


def map_in_arrow(df: DataFrame, kernel: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` for any column names, dots included."""
    names = df.columns

    def run(batches):
        return kernel(pa.RecordBatch.from_arrays(b.columns, names=names) for b in batches)

    return df.toDF(*[f"_{i}" for i in range(len(names))]).mapInArrow(run, schema)


def accumulate(df: DataFrame, kernel: Callable) -> DataFrame:
    """Run ``kernel(batches)`` per task and sum the ``(block, i, vec)`` records it yields.

    A kernel's state does not grow with its input, so tasks take many file splits each:
    what is shuffled is proportional to the number of cores, not to the data.
    """
    spark = df.sparkSession
    tasks = max(
        TASKS_PER_CORE * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    partial = map_in_arrow(df.coalesce(tasks), kernel, PARTIAL)
    total = partial.groupBy("block", "i").agg(
        Summarizer.sum(array_to_vector(F.col("vec"))).alias("v")
    )
    return total.select("block", "i", vector_to_array("v").alias("vec"))


def spread(df: DataFrame) -> DataFrame:
    """Deal a table with fewer file splits than cores over all cores, before work that is heavy per row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def panels(columns: int, blocks: int = 1) -> list[tuple[int, int]]:
    """Ranges of matrix rows such that one scan's accumulators stay within STATE_BYTES."""
    height = max(1, STATE_BYTES // (8 * max(columns, 1) * max(blocks, 1)))
    return [(lo, min(columns, lo + height)) for lo in range(0, columns, height)]


def cross_products(
    df: DataFrame,
    columns: list[str],
    shift: np.ndarray | None = None,
    scale: np.ndarray | None = None,
    by: str | None = None,
    groups: int = 1,
) -> DataFrame:
    """Cross products of ``[1, z]`` over the rows complete in ``columns``, z = (x-shift)/scale.

    Row 0 of each block holds the count and the sums. ``by`` names an int column with values
    below ``groups``; each gets its own block.
    """
    p = len(columns)
    centre = np.zeros(p) if shift is None else np.asarray(shift, dtype=float)
    width = np.ones(p) if scale is None else np.asarray(scale, dtype=float)

    def panel(lo: int, hi: int) -> DataFrame:
        def kernel(batches):
            total = np.zeros((groups, hi - lo, p + 1))
            for batch in batches:
                x = matrix(batch, columns)
                whole = ~np.isnan(x).any(axis=1)
                z = (x[whole] - centre) / width
                a = np.column_stack([np.ones(len(z)), z])
                if by is None:
                    total[0] += a[:, lo:hi].T @ a
                else:
                    g = batch.column(batch.schema.get_field_index(by)).to_numpy(
                        zero_copy_only=False
                    )[whole]
                    for b in np.unique(g):
                        part = a[g == b]
                        total[int(b)] += part[:, lo:hi].T @ part
            yield from as_partials(total)

        wanted = [*columns, by] if by else columns
        rows = accumulate(df.select(*[F.col(f"`{c}`") for c in wanted]), kernel)
        return rows.withColumn("i", F.col("i") + lo)

    frames = [panel(lo, hi) for lo, hi in panels(p + 1, groups)]
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def collect_blocks(rows: DataFrame, blocks: int, size: int) -> np.ndarray:
    """Summed records as one array; its size follows the columns, never the rows."""
    if blocks * size * size * 8 > 4 * STATE_BYTES:
        raise ValueError(f"{blocks} x {size}^2 matrix is too large for the driver")
    out = np.zeros((blocks, size, size))
    for record in rows.collect():
        out[record["block"], record["i"]] = record["vec"]
    return out


def correlation_of(total: np.ndarray) -> np.ndarray:
    """Pearson correlation from summed cross products; constant columns give 0."""
    n = total[0, 0]
    mean = total[0, 1:] / n
    cov = total[1:, 1:] / n - np.outer(mean, mean)
    deviation = np.sqrt(np.clip(np.diag(cov), 0, None))
    deviation[deviation < 1e-10] = np.inf
    corr = np.clip(cov / np.outer(deviation, deviation), -1.0, 1.0)
    np.fill_diagonal(corr, 1.0)
    return (corr + corr.T) / 2
