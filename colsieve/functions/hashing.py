"""Hash ranks, seeds and the CountSketch hash family."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Independent random tracks, and the 61-bit mask of the sketch hash.
TRACKS = {"statistics": 0, "spearman": 1, "hsic": 2, "rdc": 3}
SKETCH_MASK = (1 << 61) - 1

DIGITS = 3  # hex digits looked at in one step: 4096 equally filled hash buckets
BUCKET_ROWS = 1_000_000  # rows that one task may order


def hash_key(keys: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash_cuts(df: DataFrame, keys: list[str], seed: int, ranks) -> list[str]:
    """Hashes at given 1-based ranks of md5(keys, seed) over all rows.

    ``ranks(n)`` lists the wanted ranks for n rows; rank 0 gives '' (below every hash). Only
    the keys are read: uniform hash buckets are counted, those that hold a wanted rank are split
    further until they are small, and the rows of these few are put in order. Rows can then be
    assigned by comparing hashes, without moving them. ``keys`` should identify a row; copies of
    a key stay together.
    """
    hashed = df.select(hash_key(keys, seed).alias("_h"))
    places, n = {}, None
    within: list[str] = [""]
    for width in range(DIGITS, 33, DIGITS):
        rows = hashed if within == [""] else hashed.filter(F.substring("_h", 1, width - DIGITS).isin(within))
        sizes = dict(sorted(map(tuple, rows.groupBy(F.substring("_h", 1, width)).count().collect())))
        if n is None:
            n = sum(sizes.values())
            places = {rank: ("", rank) for rank in ranks(n) if rank > 0}
        for rank, (prefix, left) in places.items():
            if prefix not in within:
                continue
            for bucket, size in sizes.items():
                if bucket.startswith(prefix):
                    if left <= size:
                        places[rank] = (bucket, left)
                        break
                    left -= size
        within = sorted({b for b, _ in places.values() if sizes.get(b, 0) > BUCKET_ROWS})
        if not within:
            break
    wanted = sorted(set(places.values()))
    if not wanted:
        return ["" for _ in ranks(n)]
    holder, test = F.lit(None).cast("string"), F.lit(False)
    for bucket, place in wanted:
        holder = F.when(F.col("_h").startswith(bucket), F.lit(bucket)).otherwise(holder)
        test = test | ((F.col("_b") == bucket) & (F.col("_r") == place))
    order = Window.partitionBy("_b").orderBy("_h")
    ordered = hashed.withColumn("_b", holder).filter("_b IS NOT NULL").withColumn("_r", F.row_number().over(order))
    found = {(r["_b"], r["_r"]): r["_h"] for r in ordered.filter(test).collect()}  # one per wanted rank
    return [found[places[rank]] if rank > 0 else "" for rank in ranks(n)]


def rng(base: int, track: str, index: int) -> np.random.Generator:
    """Independent generator per (track, index); the same whatever was drawn before."""
    if track not in TRACKS:
        raise ValueError(f"unknown track {track!r}")
    return np.random.default_rng(np.random.SeedSequence([base, TRACKS[track], index]))


def seeds(base: int, track: str, n: int) -> list[int]:
    return [int(rng(base, track, i).integers(0, 2**31)) for i in range(n)]


def projections(base: int, track: str, repetitions: int, columns: int, features: int) -> np.ndarray:
    """Gaussian weights, shaped (repetition, column, feature)."""
    return np.stack(
        [rng(base, track, r).standard_normal((columns, features)) for r in range(repetitions)]
    )


def sketch_parameters(m: int, seed: int) -> tuple[int, list[int]]:
    """Bucket count as the next power of two, and the six multipliers and offsets."""
    size = 1 << max(m - 1, 0).bit_length()
    drawn = np.random.default_rng(seed).integers(1, SKETCH_MASK, 6, dtype=np.uint64)
    return size, [int(v) for v in drawn]


def _low_bits(x: Column, a: int, b: int, c: int, size: int) -> Column:
    """(a * (x xor b) + c) mod size; the low bits need no wider arithmetic than int64."""
    mask = size - 1
    scrambled = x.cast("long").bitwiseXOR(F.lit(b).cast("long")).bitwiseAND(F.lit(mask).cast("long"))
    return (scrambled * F.lit(a & mask).cast("long") + F.lit(c & mask)).bitwiseAND(
        F.lit(mask).cast("long")
    )


def sketch_bucket(x: Column, m: int, seed: int) -> Column:
    size, (a, b, c, *_) = sketch_parameters(m, seed)
    if size > 1 << 31:
        raise ValueError("at most 2**31 buckets")
    return _low_bits(x, a, b, c, size)


def sketch_sign(x: Column, m: int, seed: int) -> Column:
    _, (*_, a, b, c) = sketch_parameters(m, seed)
    return F.when(_low_bits(x, a, b, c, 2) == 0, 1.0).otherwise(-1.0)
