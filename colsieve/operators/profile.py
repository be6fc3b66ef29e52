"""Column statistics, exact quantiles, CDF tables and the variance filter (pass 1)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colsieve.functions.ranking import with_slices
from colsieve.operators.selection import quantile_rows
from colsieve.session import cut_lineage

# Smallest range used as a divisor, and the CDF table resolution.
RANGE_EPS = 1e-6
CDF_POINTS = 1000

COLUMNS_PER_JOB = 64
# Rows of a slice that one task orders, and slices at least.
SLICE_ROWS = 1_000_000
LEAST_SLICES = 64


def cdf_probs(points: int = CDF_POINTS) -> list[float]:
    return [i / (points - 1) for i in range(points)]


def _batches(columns: list[str], size: int) -> list[list[str]]:
    return [columns[i : i + size] for i in range(0, len(columns), size)]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def _per_column(df: DataFrame, columns: list[str], fields) -> DataFrame:
    """One aggregate over the whole table, turned into one row per column."""
    cells = [
        F.struct(F.lit(c).alias("col"), *[v.alias(n) for n, v in fields(F.col(f"`{c}`"))])
        for c in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def _moment_fields(c: Column):
    return [
        ("n_total", F.count(F.lit(1))), ("n_valid", F.count(c)), ("mean", F.avg(c)),
        ("std", F.stddev_pop(c)), ("min", F.min(c)), ("max", F.max(c)),
    ]


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """Counts, mean, population deviation and bounds: one scan per 64 columns."""
    return _union([_per_column(df, b, _moment_fields) for b in _batches(columns, COLUMNS_PER_JOB)])


def quantiles(
    df: DataFrame, columns: list[str], probs: list[float], strategy: str = "exact",
    n_rows: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles as ``(col, q array<double>)``.

    ``exact`` narrows down the wanted ranks by counts in a few scans, in the same way at any number
    of rows (``operators.selection``). ``sketch`` trades exactness (rank error 1e-4) for a single
    scan. ``n_rows`` isn't needed any more.
    """
    if strategy == "sketch":
        def fields(c: Column):
            return [("q", F.percentile_approx(c, list(probs), 10_000).cast("array<double>"))]

        return _union([_per_column(df, b, fields) for b in _batches(columns, COLUMNS_PER_JOB)])
    if strategy != "exact":
        raise ValueError(f"unknown strategy {strategy!r}")
    return _union([quantile_rows(df, b, probs) for b in _batches(columns, COLUMNS_PER_JOB)])


def measures(
    df: DataFrame, columns: list[str], probs: list[float], strategy: str = "exact",
    n_rows: int | None = None,
) -> DataFrame:
    """Moments and quantiles together."""
    return moments(df, columns).join(quantiles(df, columns, probs, strategy, n_rows), "col")


def _slice_count(n_rows: int, n_probs: int) -> int:
    """Slices small enough to sort, and so many that for a few ranks most hold none."""
    return max(2, math.ceil(n_rows / SLICE_ROWS), min(max(LEAST_SLICES, n_probs), n_rows))


def _long_slices(df: DataFrame, columns: list[str], count: int) -> tuple[DataFrame, DataFrame]:
    """Every value as ``(pos, slice, value)``, and where each slice starts among the ranks."""
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    values = [f"_v{i}" for i in range(len(columns))]
    names = [f"_s{i}" for i in range(len(columns))]
    sliced = with_slices(numbers, values, names, count)
    cells = [
        F.struct(F.lit(i).alias("pos"), F.col(s).alias("slice"), F.col(v).alias("value"))
        for i, (v, s) in enumerate(zip(values, names))
    ]
    long = sliced.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    sizes = long.groupBy("pos", "slice").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("pos").orderBy("slice")
    placed = sizes.select(
        "pos", "slice",
        (F.sum("n").over(upto) - F.col("n")).alias("first"),
        F.sum("n").over(upto).alias("last"),
        F.sum("n").over(Window.partitionBy("pos")).alias("n_valid"),
    )
    return long, cut_lineage(placed)  # columns x slices rows, used several times


def average_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean 1-based rank of each distinct value per column: ``(pos, value, rank)``."""
    long, placed = _long_slices(df, columns, _slice_count(df.count(), 0))
    counts = long.groupBy("pos", "slice", "value").agg(F.count("*").alias("k"))
    inside = Window.partitionBy("pos", "slice").orderBy("value")
    spans = counts.withColumn("upto", F.sum("k").over(inside)).join(
        placed.select("pos", "slice", "first"), ["pos", "slice"]
    )
    rank = F.col("first") + F.col("upto") - (F.col("k") - 1) / 2
    return spans.select("pos", "value", rank.alias("rank"))


def cdf_tables(
    df: DataFrame, columns: list[str], points: int = CDF_POINTS, strategy: str = "exact",
    n_rows: int | None = None,
) -> DataFrame:
    """Per column the quantiles at i/(points-1), which never decrease: ``(col, cdf)``."""
    return quantiles(df, columns, cdf_probs(points), strategy, n_rows).withColumnRenamed("q", "cdf")


def profile(
    df: DataFrame, columns: list[str], trim: tuple[float, float] = (0.025, 0.975),
    strategy: str = "exact", n_rows: int | None = None, cdf_points: int = 0,
) -> DataFrame:
    """One row per column with the measures that decide what is kept.

    With ``cdf_points`` the CDF table comes along as column ``cdf``.
    """
    probs = [*trim, *(cdf_probs(cdf_points) if cdf_points else [])]
    measured = measures(df, columns, probs, strategy, n_rows)
    position = df.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate(columns)], "pos int, col string"
    )
    joined = measured.join(F.broadcast(position), "col")
    table = [F.slice("q", 3, cdf_points).alias("cdf")] if cdf_points else []
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    base = joined.select(
        "pos", "col", "n_total", "n_valid",
        (F.col("n_total") - F.col("n_valid")).alias("n_missing"),
        F.try_divide(F.col("n_total") - F.col("n_valid"), F.col("n_total")).alias("missing_ratio"),
        zero("mean").alias("mean"), zero("std").alias("std"),
        zero("min").alias("min"), zero("max").alias("max"),
        F.greatest(
            F.coalesce(F.col("q")[1] - F.col("q")[0], F.lit(0.0)), F.lit(RANGE_EPS)
        ).alias("trimmed_range"),
        *table,
    )
    return base.select(
        "*",
        (F.col("std") * F.col("std")).alias("variance"),
        F.greatest(F.col("max") - F.col("min"), F.lit(RANGE_EPS)).alias("range"),
    ).select(
        "*",
        (F.col("variance") / (F.col("range") * F.col("range"))).alias("norm_variance"),
        (F.col("variance") / (F.col("trimmed_range") * F.col("trimmed_range"))).alias(
            "norm_variance_robust"
        ),
    )


def keep_reason(
    variance_threshold: float = 0.002, max_missing_ratio: float = 0.5, min_effective_n: int = 100
) -> Column:
    """Why a profiled column goes: variance, then missing, then effective_n; or ``keep``."""
    return (
        F.when(F.col("norm_variance") < variance_threshold, "variance")
        .when(F.col("missing_ratio") > max_missing_ratio, "missing")
        .when(F.col("n_valid") < min_effective_n, "effective_n")
        .otherwise("keep")
    )


def kept(profiled: DataFrame, **limits) -> DataFrame:
    return profiled.filter(keep_reason(**limits) == "keep")


def stats_of(profiled: DataFrame, columns: DataFrame) -> DataFrame:
    """Statistics of the given columns, matched by name."""
    return profiled.join(columns.select("col"), "col", "left_semi")


def clip_to_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Values outside [low, high] move to the bound; NULL stays NULL."""
    return df.select(
        *[
            F.when(
                F.col(f"`{c}`").isNotNull(),
                F.greatest(F.least(F.col(f"`{c}`"), F.lit(bounds[c][1])), F.lit(bounds[c][0])),
            ).alias(c) if c in bounds else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
