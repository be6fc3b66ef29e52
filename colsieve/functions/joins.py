"""Equi-join in which NULL keys match each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    renamed = right.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    matches = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, matches), how)
    return joined.drop(*[f"_key_{k}" for k in keys])
