"""Which kept column stands for which removed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsieve.session import cut_lineage


def merge_steps(removed: DataFrame) -> DataFrame:
    """One survivor per removed column; a later step overrides an earlier one.

    ``removed`` has removed, survivor, step.
    """
    last = F.max(F.struct("step", "survivor")).alias("w")
    return removed.groupBy("removed").agg(last).select(
        "removed", F.col("w.survivor").alias("survivor"), F.col("w.step").alias("step")
    )


def resolve(links: DataFrame) -> DataFrame:
    """Final owner of every removed column: follow survivors until one is itself kept.

    Each round doubles the distance covered, so chains of length L take log2(L) rounds.
    """
    current = cut_lineage(
        links.select("removed", F.col("survivor").alias("owner")).filter("removed <> owner")
    )
    before = None
    while True:
        ahead = current.select(F.col("removed").alias("owner"), F.col("owner").alias("next"))
        stepped = current.join(ahead, "owner", "left").select(
            "removed", F.coalesce("next", "owner").alias("owner"),
            F.col("next").isNotNull().alias("moved"),
        )
        stepped = cut_lineage(stepped)
        moved = stepped.filter("moved").count()
        current = stepped.select("removed", "owner")
        if not moved:
            return current
        if moved == before:
            raise ValueError("survivor links form a cycle")
        before = moved


def final_clusters(kept: DataFrame, removed: DataFrame) -> DataFrame:
    """Per kept column the columns it absorbed and in which pass each went.

    ``kept`` has col; ``removed`` has removed, survivor, step (2, 3 or 4). Lists hold
    column names, so their length follows the schema, not the data.
    """
    owned = resolve(merge_steps(removed))
    by_step = removed.select("removed", "step").distinct()
    history = owned.join(by_step, "removed").groupBy("owner").agg(
        F.array_sort(F.collect_set(F.when(F.col("step") == 2, F.col("removed")))).alias("pass2"),
        F.array_sort(F.collect_set(F.when(F.col("step") == 3, F.col("removed")))).alias("pass3"),
        F.array_sort(F.collect_set("removed")).alias("alternative_descriptors"),
    )
    none = F.array().cast("array<string>")
    joined = kept.select("col").join(history, kept["col"] == history["owner"], "left")
    alternatives = F.coalesce("alternative_descriptors", none)
    return joined.select(
        "col",
        (F.size(alternatives) + 1).alias("cluster_size"),
        F.lit(True).alias("is_representative"),
        alternatives.alias("alternative_descriptors"),
        F.array_sort(F.concat(alternatives, F.array("col"))).alias("all_cluster_members"),
        F.struct(
            F.coalesce("pass2", none).alias("pass2"), F.coalesce("pass3", none).alias("pass3")
        ).alias("removal_history"),
        F.size(alternatives).alias("total_alternatives"),
    )


def ownerless(kept: DataFrame, removed: DataFrame) -> DataFrame:
    """Removed columns that no kept column stands for, as (removed, step).

    They went without a survivor, or their survivors end in one that did.
    """
    last = merge_steps(removed)
    owned = resolve(last).join(kept.select(F.col("col").alias("owner")), "owner", "left_semi")
    return last.join(owned.select("removed"), "removed", "left_anti").select("removed", "step")


def cluster_sizes(owned: DataFrame, kept: DataFrame, key: str = "col") -> DataFrame:
    """Members per kept column, itself included, without building member lists."""
    counts = owned.groupBy("owner").agg(F.count("*").alias("n"))
    return kept.select(key).join(counts, F.col(key) == F.col("owner"), "left").select(
        key, (F.coalesce("n", F.lit(0)) + 1).alias("cluster_size")
    )


def size_distribution(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("cluster_size").agg(F.count("*").alias("n_clusters"))


def largest_clusters(sizes: DataFrame, key: str = "col", n: int = 20) -> DataFrame:
    return sizes.orderBy(F.col("cluster_size").desc(), key).limit(n)


def size_statistics(sizes: DataFrame) -> DataFrame:
    s = F.col("cluster_size")
    return sizes.agg(
        F.avg(s).alias("mean"), F.percentile(s, F.lit(0.5)).alias("median"),
        F.min(s).alias("min"), F.max(s).alias("max"), F.stddev_pop(s).alias("std"),
    )


def removal_distribution(owned: DataFrame, steps: DataFrame) -> DataFrame:
    """Kept columns that absorbed in pass 2 only, pass 3 only, or both."""
    flags = owned.join(steps.select("removed", "step"), "removed").groupBy("owner").agg(
        F.bool_or(F.col("step") == 2).alias("p2"), F.bool_or(F.col("step") == 3).alias("p3")
    )
    return flags.agg(
        F.count_if(F.col("p2") & ~F.col("p3")).alias("pass2_only"),
        F.count_if(~F.col("p2") & F.col("p3")).alias("pass3_only"),
        F.count_if(F.col("p2") & F.col("p3")).alias("both_passes"),
    )


def rebuild_from_steps(pass2: DataFrame, pass3: DataFrame, survivors: DataFrame) -> DataFrame:
    """Lineage from saved passes: a pass-3 column goes to its first surviving correlate.

    ``pass2`` has representative, removed; ``pass3`` has removed and the ordered array
    correlated; ``survivors`` has col.
    """
    candidates = pass3.select("removed", F.posexplode("correlated").alias("at", "col"))
    alive = candidates.join(survivors.select("col"), "col", "left_semi")
    first = alive.groupBy("removed").agg(F.min(F.struct("at", "col")).alias("w")).select(
        "removed", F.col("w.col").alias("survivor")
    )
    second = pass2.select("removed", F.col("representative").alias("survivor"))
    links = first.withColumn("step", F.lit(3)).unionByName(second.withColumn("step", F.lit(2)))
    chained = merge_steps(links)
    owned = resolve(chained).join(survivors.withColumnRenamed("col", "owner"), "owner", "left_semi")
    return owned.join(chained.select("removed", "step"), "removed").select("owner", "removed", "step")


def to_document(clusters: DataFrame, lost: DataFrame | None = None) -> dict:
    """Totals, distributions and the entry of every kept column, added up by Spark.

    What is collected is bounded by the number of columns. ``lost`` holds the columns that no kept
    one stands for, as ``ownerless`` gives them.
    """
    sizes = clusters.select("col", "cluster_size")
    two, three = (
        clusters.select(F.col("col").alias("owner"), F.explode(f"removal_history.pass{k}").alias("removed"), F.lit(k).alias("step"))
        for k in (2, 3))
    members = two.unionByName(three)
    absorbed = removal_distribution(members.select("owner", "removed").distinct(), members.select("removed", "step").distinct())
    has_others = F.col("total_alternatives") > 0
    totals = clusters.agg(
        F.count("*").alias("total_descriptors"), F.count_if(has_others).alias("descriptors_with_alternatives"),
        F.count_if(~has_others).alias("standalone_descriptors"),
        F.coalesce(F.sum("total_alternatives"), F.lit(0)).alias("total_alternative_descriptors"),
    ).first().asDict()
    without = [] if lost is None else [r["removed"] for r in lost.orderBy("removed").collect()]
    totals["ownerless_descriptors"] = len(without)
    largest = largest_clusters(sizes).select(
        F.col("col").alias("descriptor"), "cluster_size", (F.col("cluster_size") - 1).alias("alternatives"))
    return {
        "metadata": {"description": "Kept columns and all columns they stand for", "version": "6.0", **totals},
        "statistics": {
            **totals,
            "cluster_size_distribution": {
                str(size): n for size, n in map(tuple, size_distribution(sizes).orderBy("cluster_size").collect())},
            "removal_distribution": absorbed.first().asDict(),
            "largest_clusters": [r.asDict() for r in largest.collect()],
        },
        "ownerless": without,
        "descriptors": {
            name: entry.asDict(recursive=True) for name, entry in map(tuple, clusters.orderBy("col").select(
                "col", F.struct(*[c for c in clusters.columns if c != "col"])).collect())},
    }
