"""Threshold graphs on columns: edges, components, representatives, nearest neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colsieve.session import cut_lineage


def threshold_edges(pairs: DataFrame, threshold: float) -> DataFrame:
    """Undirected edges i < j with an absolute similarity of at least the threshold."""
    return pairs.filter((F.col("i") < F.col("j")) & (F.abs("s") >= threshold)).select("i", "j", "s")


def components(nodes: DataFrame, edges: DataFrame, node: str = "i") -> DataFrame:
    """Label every node with the smallest node it is connected to: ``(node, component)``.

    Two alternating steps keep rewriting the edge list until it is a set of stars: every
    node hands its larger neighbours to its smallest one, then its smaller neighbours.
    The rows per step never exceed the edges; rounds grow with the logarithm of the longest
    path. A hub's edges are aggregated before the shuffle and never gathered in one list.
    """
    current = cut_lineage(
        edges.select(
            F.greatest("i", "j").alias("a"), F.least("i", "j").alias("b")
        ).filter("a <> b").distinct()
    )
    while not _all_stars(current):
        current = cut_lineage(_small_star(_large_star(current)))
    roots = current.groupBy("a").agg(F.min("b").alias("component"))
    return nodes.select(node).join(roots.withColumnRenamed("a", node), node, "left").select(
        node, F.coalesce("component", node).alias("component")
    )


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has at most one smaller neighbour and roots have none."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    degree = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degree.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m")
    )
    moved = both.filter("b > a").join(smallest, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def quality_score(
    missing: Column, variance: Column, top_variance: Column,
    centre: Column | None = None, top_centre: Column | None = None,
) -> Column:
    """5 for completeness, 3 for relative variance, 1 for relative centrality (0.5 if unknown)."""
    central = F.lit(0.5) if centre is None else centre / (top_centre + 1e-10)
    return 5.0 * (1.0 - missing) + 3.0 * variance / (top_variance + 1e-10) + central


def elect_by_quality(profiled: DataFrame, labels: DataFrame) -> DataFrame:
    """Best column of each component; on equal scores the first in column order.

    ``profiled`` has pos, col, missing_ratio, variance; ``labels`` has i (a pos), component.
    """
    top = profiled.agg(F.max("variance")).scalar()
    scored = profiled.join(labels, profiled["pos"] == labels["i"]).select(
        "component", "pos", "col",
        quality_score(F.col("missing_ratio"), F.col("variance"), top).alias("quality"),
    )
    return _elect(scored, "quality")


def elect_by_similarity(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Column with the largest mean absolute similarity inside its component.

    The diagonal counts in the sum, as one constant for all members.
    """
    a = labels.select("i", "component")
    b = labels.select(F.col("i").alias("j"), F.col("component").alias("other"))
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    inside = pairs.join(a, "i").join(b, "j").filter(F.col("component") == F.col("other"))
    scored = (
        inside.groupBy("component", "i").agg(F.sum(F.abs("s")).alias("total"))
        .join(sizes, "component")
        .select(
            "component", F.col("i").alias("pos"),
            F.when(F.col("size") > 1, F.col("total") / (F.col("size") - 1))
            .otherwise(F.lit(1.0)).alias("mean_similarity"),
        )
    )
    return _elect(scored, "mean_similarity")


def _elect(scored: DataFrame, score: str) -> DataFrame:
    """Mark the best member per component (ties go to the lower position)."""
    best = F.max(F.struct(F.col(score).alias("score"), (-F.col("pos")).alias("near")))
    winners = scored.groupBy("component").agg(best.alias("w"), F.count("*").alias("size")).select(
        "component", "size", (-F.col("w.near")).alias("representative")
    )
    return scored.join(winners, "component").withColumn(
        "is_representative", F.col("pos") == F.col("representative")
    )


def nearest_neighbours(pairs: DataFrame, k: int = 5) -> DataFrame:
    """Undirected graph of each column's k most similar others: ``(a, b, weight)``."""
    order = Window.partitionBy("i").orderBy(F.col("s").desc(), "j")
    top = (
        pairs.filter("i <> j").withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k)
    )
    return top.groupBy(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).agg(
        F.min("s").alias("weight")
    )
