"""Similarity of columns: normal scores, Pearson, rank and random-feature dependence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colsieve.functions.hashing import projections
from colsieve.functions.normal import PROB_EPS, normal_scores, phi_inv
from colsieve.operators.gram import (
    STATE_BYTES, STEP_CELLS, accumulate, as_partials, collect_blocks, cross_products, matrix, panels, spread,
)
from colsieve.operators.profile import moments
from colsieve.operators.ranks import mean_ranks
from colsieve.session import cut_lineage

# Bytes of CDF tables that may travel with a kernel.
TABLE_BYTES = 256 << 20
# Largest Gram matrix of basis functions that the driver takes, and rows per inner step.
BASIS_BYTES = 64 << 20
BASIS_ROWS = 2048
# No normal score lies further out; scores are bounded as probabilities are.
REACH = float(np.abs(phi_inv(np.array([PROB_EPS, 1.0 - PROB_EPS]))).max()) * (1 + 1e-12)


def collect_cdfs(tables: DataFrame, columns: list[str]) -> np.ndarray:
    """CDF tables in column order, matched by name; their size follows the columns only."""
    found = {r["col"]: r["cdf"] for r in tables.select("col", "cdf").collect()}
    knots = np.array([found[c] if found[c] else [0.0, 0.0] for c in columns], dtype=float)
    if knots.nbytes > TABLE_BYTES:
        raise ValueError(f"{knots.nbytes} bytes of CDF tables; use fewer points")
    return knots


def scores_of(x: np.ndarray, knots: np.ndarray) -> np.ndarray:
    return np.column_stack([normal_scores(x[:, j], knots[j]) for j in range(x.shape[1])])


def with_normal_scores(df: DataFrame, columns: list[str], knots: np.ndarray) -> DataFrame:
    """Replace the columns by their normal scores; other columns stay."""
    others = [c for c in df.columns if c not in columns]
    schema = df.select(*others, *[F.lit(0.0).alias(c) for c in columns]).schema
    shared = df.sparkSession.sparkContext.broadcast(knots)  # at most TABLE_BYTES

    def kernel(batches):
        for batch in batches:
            z = scores_of(matrix(batch, columns), shared.value)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays(
                [*kept, *[pa.array(z[:, j]) for j in range(len(columns))]], names=[*others, *columns]
            )

    return df.mapInArrow(kernel, schema)


def as_pairs(rows: DataFrame) -> DataFrame:
    """Matrix rows ``(i, vec)`` as long ``(i, j, s)``."""
    return rows.select("i", F.posexplode("vec").alias("j", "s"))


def pairs_of(spark: SparkSession, corr: np.ndarray) -> DataFrame:
    rows = [(i, [float(v) for v in corr[i]]) for i in range(len(corr))]
    return as_pairs(spark.createDataFrame(rows, "i int, vec array<double>"))


def correlation_pairs(total: DataFrame) -> DataFrame:
    """Summed cross products of ``[1, z]`` as correlations ``(i, j, s)``, without the driver."""
    total = cut_lineage(total)  # columns x columns numbers, used four times; the scan runs once
    pairs = as_pairs(total.select("i", "vec"))
    sums = total.filter("i = 0").select(F.posexplode("vec").alias("k", "sum"))
    n = total.filter("i = 0").select(F.col("vec")[0]).scalar()
    squares = pairs.filter("i = j").select(F.col("i").alias("k"), F.col("s").alias("sq"))
    scales = (
        sums.join(squares, "k").withColumn("n", n)
        .select(
            "k", "n", (F.col("sum") / F.col("n")).alias("mean"),
            F.sqrt(
                F.greatest(F.col("sq") / F.col("n") - F.pow(F.col("sum") / F.col("n"), 2), F.lit(0.0))
            ).alias("sd"),
        )
    )
    left = scales.select(F.col("k").alias("i"), "n", F.col("mean").alias("mi"), F.col("sd").alias("si"))
    right = scales.select(F.col("k").alias("j"), F.col("mean").alias("mj"), F.col("sd").alias("sj"))
    covariance = F.col("s") / F.col("n") - F.col("mi") * F.col("mj")
    flat = (F.col("si") < 1e-10) | (F.col("sj") < 1e-10)
    value = F.when(F.col("i") == F.col("j"), 1.0).when(flat, 0.0).otherwise(
        F.greatest(F.least(F.try_divide(covariance, F.col("si") * F.col("sj")), F.lit(1.0)), F.lit(-1.0))
    )
    return (
        pairs.filter("i > 0 and j > 0").join(left, "i").join(right, "j")
        .select((F.col("i") - 1).alias("i"), (F.col("j") - 1).alias("j"), value.alias("s"))
    )


def normal_scores_correlation(df: DataFrame, columns: list[str], knots: np.ndarray) -> DataFrame:
    """Correlation of normal scores with missing values at the median: long ``(i, j, s)``."""
    shared = df.sparkSession.sparkContext.broadcast(knots)  # at most TABLE_BYTES
    p = len(columns)

    def panel(lo: int, hi: int) -> DataFrame:
        def kernel(batches):
            total = np.zeros((1, hi - lo, p + 1))
            for batch in batches:
                z = scores_of(matrix(batch, columns), shared.value)
                a = np.column_stack([np.ones(len(z)), z])
                total[0] += a[:, lo:hi].T @ a
            yield from as_partials(total)

        rows = accumulate(df.select(*[F.col(f"`{c}`") for c in columns]), kernel)
        return rows.withColumn("i", F.col("i") + lo)

    frames = [panel(lo, hi) for lo, hi in panels(p + 1)]
    total = frames[0]
    for other in frames[1:]:
        total = total.unionByName(other)
    return correlation_pairs(total)


def pearson_pairwise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of each pair over the rows complete in that pair: long ``(i, j, s)``.

    One scan finds the means, a second one four matrices: how many rows a pair shares, and
    over those the sums, squares and products of the values.
    """
    p = len(columns)
    means = {r["col"]: r["mean"] or 0.0 for r in moments(df, columns).select("col", "mean").collect()}
    centre = np.array([means[c] for c in columns])

    def panel(lo: int, hi: int) -> DataFrame:
        def kernel(batches):
            total = np.zeros((4, hi - lo, p))
            for batch in batches:
                x = matrix(batch, columns) - centre
                there = (~np.isnan(x)).astype(float)
                x = np.nan_to_num(x)
                total[0] += there[:, lo:hi].T @ there
                total[1] += x[:, lo:hi].T @ there
                total[2] += (x[:, lo:hi] ** 2).T @ there
                total[3] += x[:, lo:hi].T @ x
            yield from as_partials(total)

        rows = accumulate(df.select(*[F.col(f"`{c}`") for c in columns]), kernel)
        return rows.withColumn("i", F.col("i") + lo)

    frames = [panel(lo, hi) for lo, hi in panels(p, 4)]
    total = frames[0]
    for other in frames[1:]:
        total = total.unionByName(other)
    sums = total.select("block", "i", F.posexplode("vec").alias("j", "v")).groupBy("i", "j").agg(
        *[F.sum(F.when(F.col("block") == k, F.col("v"))).alias(n)
          for k, n in enumerate(("n", "sx", "sxx", "sxy"))]
    )
    # Both halves of a pair meet in one group: (i, j) as it is and (j, i) turned round.
    turned = sums.select(
        F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "n", "sx", "sxx", "sxy",
        (F.col("i") <= F.col("j")).alias("upper"),
    )
    side = lambda c, up: F.max(F.when(F.col("upper") == up, F.col(c)))
    pair = turned.groupBy("a", "b").agg(
        side("n", True).alias("n"), side("sxy", True).alias("sxy"),
        side("sx", True).alias("xa"), F.coalesce(side("sx", False), side("sx", True)).alias("xb"),
        side("sxx", True).alias("qa"), F.coalesce(side("sxx", False), side("sxx", True)).alias("qb"),
    )
    n = F.col("n")
    va = n * F.col("qa") - F.col("xa") * F.col("xa")
    vb = n * F.col("qb") - F.col("xb") * F.col("xb")
    scale = F.sqrt(F.greatest(va, F.lit(0.0)) * F.greatest(vb, F.lit(0.0)))
    value = F.try_divide(n * F.col("sxy") - F.col("xa") * F.col("xb"), scale)
    upper = pair.select(
        F.col("a").alias("i"), F.col("b").alias("j"),
        F.when(F.col("a") == F.col("b"), 1.0)
        .otherwise(F.greatest(F.least(value, F.lit(1.0)), F.lit(-1.0))).alias("s"),
    )
    return upper.select(
        F.inline(
            F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j", "s"))).otherwise(
                F.array(F.struct("i", "j", "s"),
                        F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "s"))
            )
        )
    )


def rank_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Spearman's rho over the complete rows, ties at their mean rank: long ``(i, j, s)``.

    Ranks come as one array a row (``operators.ranks``), in two shuffles for any number of columns.
    """
    p = len(columns)
    ranks = mean_ranks(df, columns)
    n = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{k}") for k, c in enumerate(columns)]).na.drop().count()
    ranked = ranks.select(*[F.col("ranks")[k].alias(f"_r{k}") for k in range(p)])
    total = cross_products(
        ranked, [f"_r{i}" for i in range(p)], np.full(p, (n + 1) / 2), np.full(p, max(n, 1) / 12**0.5)
    )
    return correlation_pairs(total)


def _sines(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """sin(z_j w_jl) as (column, row, feature)."""
    return np.sin(z.T[:, :, None] * weights[:, None, :])


def sine_coefficients(weights: np.ndarray) -> np.ndarray:
    """sin(w REACH t) as sums of odd Chebyshev polynomials of t in [-1, 1]: (column, feature, term).

    The sums differ from the sines by rounding only; the terms needed follow the largest weight.
    """
    top = float(np.abs(weights).max()) * REACH
    nodes = 2 * int(np.ceil(top)) + 64
    angle = np.pi * (np.arange(nodes) + 0.5) / nodes
    cosines = np.cos(np.outer(angle, np.arange(1, nodes, 2))) * (2 / nodes)
    largest = np.abs(np.sin(top * np.cos(angle)) @ cosines)
    terms = int(np.flatnonzero(largest > 1e-15)[-1]) + 1 if top else 1
    return np.stack([np.sin(np.outer(w, REACH * np.cos(angle))) @ cosines[:, :terms] for w in weights])


def _basis(z: np.ndarray, terms: int) -> np.ndarray:
    """1 and the first odd Chebyshev polynomials of every column, one row per function."""
    t = z.T / REACH
    out = np.empty((1 + t.shape[0] * terms, t.shape[1]))
    out[0] = 1.0
    each = out[1:].reshape(t.shape[0], terms, -1)
    twice = 4 * t * t - 2
    before, now = t, t
    for k in range(terms):
        each[:, k] = now
        before, now = now, twice * now - before
    return out


def _dependence_of(total: np.ndarray, coefficients: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Per block the mean correlation of the features, from summed products of basis functions."""
    p, features, terms = coefficients.shape
    n = max(total[0, 0], 1.0)
    grams = total[1:, 1:].reshape(p, terms, p, terms) / n
    means = np.stack([coefficients[i] @ total[0, 1 + i * terms : 1 + (i + 1) * terms] / n for i in range(p)])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int)
    cov = np.empty((p, p, features))
    for i in range(p):
        for j in range(i, p):
            product = ((coefficients[i] @ grams[i, :, j]) * coefficients[j]).sum(1)
            cov[i, j] = cov[j, i] = product - means[i] * means[j]
    variance = np.clip(cov[np.arange(p), np.arange(p)], 0, None)
    deviation = np.sqrt(variance * n / max(n - 1, 1))
    deviation[deviation < 1e-6] = np.inf  # rounding; such a feature doesn't vary
    return np.add.reduceat(cov / (deviation[:, None] * deviation[None]), starts, axis=2) / np.array(sizes)


def _by_basis(df: DataFrame, columns: list[str], knots: np.ndarray, coefficients: np.ndarray, sizes: list[int]) -> DataFrame:
    spark, (p, _, terms) = df.sparkSession, coefficients.shape
    tables = spark.sparkContext.broadcast(knots)  # at most TABLE_BYTES
    size = 1 + p * terms

    def kernel(batches):
        total = np.zeros((size, size))
        for batch in batches:
            z = scores_of(matrix(batch, columns), tables.value)
            for at in range(0, len(z), BASIS_ROWS):
                functions = _basis(z[at : at + BASIS_ROWS], terms)
                total += functions @ functions.T
        yield from as_partials([total])

    source = spread(df.select(*[F.col(f"`{c}`") for c in columns]))
    found = _dependence_of(collect_blocks(accumulate(source, kernel), 1, size)[0], coefficients, sizes)
    i, j, block = (x.ravel() for x in np.meshgrid(np.arange(p), np.arange(p), np.arange(len(sizes)), indexing="ij"))
    rows = pa.table({"block": pa.array(block, pa.int32()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                     "s": np.clip(found, -1, 1).ravel()})
    return spark.createDataFrame(rows, "block int, i int, j int, s double")


def sine_dependence(
    df: DataFrame, columns: list[str], knots: np.ndarray | None, weights,
) -> DataFrame:
    """Mean correlation of random sine features per weight block: ``(block, i, j, s)``.

    ``weights`` holds one (column, feature) array per block; blocks may differ in their number
    of features and share their scans. With ``knots`` the columns are bounded normal scores, so every
    sine is a sum of a few polynomials of them: one scan adds up the products of polynomials, whatever
    the number of features, and the features' sums follow from these. Where that matrix is too large
    (``BASIS_BYTES``), or columns have no bound, there are two scans over the features. The first scan finds mean and deviation of every
    feature, the second adds up products of standardised features. With ``knots`` the columns
    pass through normal scores first. Blocks are split over several pairs of scans where their
    matrices would not fit in a task.
    """
    p = len(columns)
    weights = [np.asarray(w) for w in weights]
    if knots is not None:
        coefficients = sine_coefficients(np.concatenate(weights, axis=1))
        if 8 * (1 + p * coefficients.shape[2]) ** 2 <= BASIS_BYTES:
            return _by_basis(df, columns, knots, coefficients, [w.shape[1] for w in weights])
    context = df.sparkSession.sparkContext
    source = spread(df.select(*[F.col(f"`{c}`") for c in columns]))
    tables = context.broadcast(knots)  # at most TABLE_BYTES

    def scored(batches, part):
        step = max(1, STEP_CELLS // (p * max(w.shape[1] for w in part)))
        for batch in batches:
            x = matrix(batch, columns)
            z = np.nan_to_num(x) if tables.value is None else scores_of(x, tables.value)
            for at in range(0, len(z), step):
                yield z[at : at + step]

    widest = max(w.shape[1] for w in weights)
    per_scan = max(1, STATE_BYTES // (8 * p * max(p, 1 + 2 * widest)))
    out = None
    for start in range(0, len(weights), per_scan):
        shared = context.broadcast(weights[start : start + per_scan])  # within STATE_BYTES

        def first(batches, shared=shared):
            part = shared.value
            total = [np.zeros((p, 1 + 2 * w.shape[1])) for w in part]
            for z in scored(batches, part):
                for w, sums in zip(part, total):
                    s = _sines(z, w)
                    d = w.shape[1]
                    sums[:, 0] += len(z)
                    sums[:, 1 : 1 + d] += s.sum(axis=1)
                    sums[:, 1 + d :] += np.einsum("ijk,ijk->ik", s, s)
            yield from as_partials(total)

        centre = [np.zeros(w.shape) for w in shared.value]
        width = [np.ones(w.shape) for w in shared.value]
        total_rows = 0.0
        for r in accumulate(source, first).collect():  # one row per block and column
            v = np.array(r["vec"])
            d = (len(v) - 1) // 2
            total_rows = v[0]
            mean = v[1 : 1 + d] / total_rows
            variance = np.clip(v[1 + d :] / total_rows - mean**2, 0, None)
            sd = np.sqrt(variance * total_rows / max(total_rows - 1, 1))
            centre[r["block"]][r["i"]] = mean
            width[r["block"]][r["i"]] = np.where(sd < 1e-10, 1.0, sd)
        scale = context.broadcast((centre, width))

        def second(batches, shared=shared, scale=scale):
            part = shared.value
            means, widths = scale.value
            total = np.zeros((len(part), p, p))
            for z in scored(batches, part):
                for b, w in enumerate(part):
                    s = _sines(z, w)
                    s -= means[b][:, None, :]
                    s /= widths[b][:, None, :]
                    flat = s.reshape(p, -1)
                    total[b] += flat @ flat.T / w.shape[1]
            yield from as_partials(total)

        mean_product = F.col("s") / max(total_rows, 1.0)
        bounded = F.greatest(F.least(mean_product, F.lit(1.0)), F.lit(-1.0))
        done = accumulate(source, second).select(
            (F.col("block") + start).alias("block"), "i", F.posexplode("vec").alias("j", "s")
        ).select("block", "i", "j", bounded.alias("s"))
        out = done if out is None else out.unionByName(done)
    return out


def lower_median(blocks: DataFrame, per_repetition: int = 1) -> DataFrame:
    """Average each run of ``per_repetition`` blocks, then the lower median over the runs."""
    if per_repetition > 1:
        run = F.floor(F.col("block") / per_repetition).alias("block")
        blocks = blocks.groupBy(run, "i", "j").agg(F.avg("s").alias("s"))
    middle = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY s)")
    return blocks.groupBy("i", "j").agg(middle.alias("s")).select(
        "i", "j", F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.col("s")).alias("s")
    )


def hsic_like(
    df: DataFrame, columns: list[str], knots: np.ndarray, seed: int = 42,
    features: int = 50, repetitions: int = 8,
) -> DataFrame:
    """HSIC-style dependence: lower median over repetitions."""
    w = projections(seed, "hsic", repetitions, len(columns), features)
    return lower_median(sine_dependence(df, columns, knots, w))


def rdc_like(
    df: DataFrame, columns: list[str], knots: np.ndarray, seed: int = 42,
    features: int = 20, repetitions: int = 8, draws: int = 10,
) -> DataFrame:
    """RDC-style dependence: mean over draws, then lower median over repetitions."""
    w = projections(seed, "rdc", repetitions * draws, len(columns), features)
    return lower_median(sine_dependence(df, columns, knots, w), draws)


def both_dependences(
    df: DataFrame, columns: list[str], knots: np.ndarray, seed: int = 42, repetitions: int = 8,
    hsic_features: int = 50, rdc_features: int = 20, draws: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """``hsic_like`` and ``rdc_like`` from the same scans."""
    p = len(columns)
    h = projections(seed, "hsic", repetitions, p, hsic_features)
    r = projections(seed, "rdc", repetitions * draws, p, rdc_features)
    blocks = cut_lineage(sine_dependence(df, columns, knots, [*h, *r]))
    later = blocks.filter(F.col("block") >= repetitions).withColumn("block", F.col("block") - repetitions)
    return lower_median(blocks.filter(F.col("block") < repetitions)), lower_median(later, draws)


def fuse(h: DataFrame, r: DataFrame, w_h: float = 0.5, w_r: float = 0.5) -> DataFrame:
    """Weighted mean of two similarities (weights rescaled to sum 1), clamped, diagonal 1."""
    if w_h < 0 or w_r < 0 or w_h + w_r == 0:
        raise ValueError("fusion weights must be non-negative and not both zero")
    a, b = w_h / (w_h + w_r), w_r / (w_h + w_r)
    both = h.withColumnRenamed("s", "h").join(r.withColumnRenamed("s", "r"), ["i", "j"])
    mixed = F.greatest(F.least(a * F.col("h") + b * F.col("r"), F.lit(1.0)), F.lit(-1.0))
    return both.select("i", "j", F.when(F.col("i") == F.col("j"), 1.0).otherwise(mixed).alias("s"))


def centrality(pairs: DataFrame) -> DataFrame:
    """Mean similarity of each column to all columns."""
    return pairs.groupBy("i").agg(F.avg("s").alias("centrality"))
