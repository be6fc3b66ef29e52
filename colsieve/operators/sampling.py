"""Deterministic fixed-size samples per file or group (pass 0)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colsieve.functions.hashing import hash_key
from colsieve.functions.joins import join_null_safe
from colsieve.session import cut_lineage


def sample_per_group(
    df: DataFrame, group: str, keys: list[str], k: int, seed: int = 42
) -> DataFrame:
    """All rows of a group with at most k rows, else the k rows with the smallest hash.

    The hash depends on the row alone, so adding a file leaves the others' samples alone.
    """
    hashed = _keep_small_hashes(df.withColumn("_h", hash_key(keys, seed)), group, k)
    order = Window.partitionBy(group).orderBy("_h", *keys)
    return hashed.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop(
        "_h", "_r"
    )


def _keep_small_hashes(hashed: DataFrame, group: str, k: int) -> DataFrame:
    """Drop rows whose hash is far too large to be among the k first of their group.

    Hashes are uniform, so k of n rows lie below about k/n; the cut leaves a wide margin. A group
    that still keeps fewer than k rows comes back whole, so the answer is always exact.
    """
    counts = cut_lineage(hashed.groupBy(group).agg(F.count("*").alias("_n")))
    share = F.conv(F.substring("_h", 1, 12), 16, 10).cast("double") / float(16**12)
    margin = k + 8 * math.sqrt(k) + 50
    near = join_null_safe(hashed, counts, [group]).filter(share * F.col("_n") <= margin)
    held = near.groupBy(group).agg(F.count("*").alias("_held"), F.first("_n").alias("_n"))
    enough = held.filter(F.col("_held") >= F.least(F.lit(k), F.col("_n")))
    missed = join_null_safe(counts, enough.select(group), [group], "left_anti")
    missed = cut_lineage(missed.select(group))
    held_well = join_null_safe(near.drop("_n"), missed, [group], "left_anti")
    return held_well.unionByName(join_null_safe(hashed, missed, [group], "left_semi"))


def sample_addresses(
    df: DataFrame, group: str, keys: list[str], k: int, seed: int = 42
) -> DataFrame:
    """Only the keys of the sampled rows, to be saved and read back by address."""
    return sample_per_group(df.select(group, *[c for c in keys if c != group]), group, keys, k, seed)
