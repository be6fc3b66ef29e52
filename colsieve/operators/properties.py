"""Named property matching and the numeric range filter on records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.functions.text import label_of, name_of, norm_label, norm_text, property_key


def matches(key: Column, target: str, aliases: list[str] | None = None) -> Column:
    """Whether the full key or its label spells the target or one of its aliases."""
    names = list(dict.fromkeys(norm_text(s) for s in [target, *(aliases or [])]))
    label = label_of(key)
    full = property_key(label, F.coalesce(name_of(key), F.lit("")))
    return norm_label(full).isin(names) | norm_label(label).isin(names)


def matching_value(props: Column, target: str, aliases: list[str] | None = None) -> Column:
    """Value of the first property (document order) that matches."""
    return F.try_element_at(
        F.filter(props, lambda e: matches(e["key"], target, aliases)), F.lit(1)
    )["value"]


def range_outcome(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """``passed``, ``filtered`` (outside the inclusive bounds) or ``missing`` (no number)."""
    number = value.try_cast("double")
    outside = F.lit(False)
    if low is not None:
        outside = outside | (number < low)
    if high is not None:
        outside = outside | (number > high)
    return F.when(number.isNull(), "missing").when(outside, "filtered").otherwise("passed")


def filter_by_range(
    df: DataFrame, value: Column, low: float | None = None, high: float | None = None
) -> DataFrame:
    return df.filter(range_outcome(value, low, high) == "passed")


def range_counts(
    df: DataFrame, value: Column, low: float | None = None, high: float | None = None
) -> DataFrame:
    """How many records were checked, passed, filtered or lacked the property."""
    outcome = range_outcome(value, low, high)
    return df.select(outcome.alias("o")).agg(
        F.count("*").alias("checked"), F.count_if(F.col("o") == "passed").alias("passed"),
        F.count_if(F.col("o") == "filtered").alias("filtered"),
        F.count_if(F.col("o") == "missing").alias("missing"),
    )
