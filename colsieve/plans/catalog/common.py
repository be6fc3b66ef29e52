"""Shared pieces of the named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        CATALOG[function.__name__] = (function, sql)
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Planted structure on lineitem: near copies, a constant and two columns with gaps.
FEATURE_EXPRESSIONS = {
    "f1": "l_quantity",
    "f2": "l_extendedprice",
    "f3": "l_discount",
    "f4": "l_tax",
    "f5": "l_extendedprice * (1 - l_discount)",
    "f6": "l_extendedprice * (1 - l_discount) * (1 + l_tax)",
    "f7": "l_quantity * l_quantity",
    "f8": "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity + 10 * l_discount END",
    "f9": "CAST(1.0 AS DOUBLE)",
    "f10": "CASE WHEN l_linenumber % 3 <> 0 THEN NULL ELSE l_tax END",
}
FEATURES = list(FEATURE_EXPRESSIONS)
USABLE = FEATURES[:8]


def features(spark: SparkSession, folder: str, names: list[str] = FEATURES) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        *[F.expr(FEATURE_EXPRESSIONS[n]).cast("double").alias(n) for n in names]
    )


def features_sql(names: list[str] = FEATURES) -> str:
    return "SELECT " + ", ".join(
        f"CAST({FEATURE_EXPRESSIONS[n]} AS DOUBLE) AS {n}" for n in names
    ) + " FROM lineitem"


def long_sql(names: list[str], source: str, keep: str = "") -> str:
    """Rows (keep, col, value) of a wide relation, gaps included."""
    kept = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {kept}'{n}' AS col, {n} AS value FROM {source}" for n in names)


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def named(names: list[str], position: str) -> Column:
    """Column name at a 0-based position."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.col(position).cast("int") + 1)


def name_pairs(pairs: DataFrame, names: list[str]) -> DataFrame:
    """Pairs i < j with names in place of positions."""
    return pairs.filter("i < j").select(
        named(names, "i").alias("a"), named(names, "j").alias("b"), r6("s").alias("s")
    )
