"""Leiden communities against brute force over moves, merges and whole partitions."""

import random

import pytest
from pyspark.sql import functions as F

from colsieve.operators import communities as C
from colsieve.plans.catalog import CATALOG


def value(links, part, resolution):
    inside = sum(w for a, b, w in links if part[a] == part[b])
    sizes = {}
    for c in part.values():
        sizes[c] = sizes.get(c, 0) + 1
    return inside - resolution * sum(n * (n - 1) / 2 for n in sizes.values())


def connected(links, part):
    for c in set(part.values()):
        members = {n for n in part if part[n] == c}
        reached, open_ = {min(members)}, [min(members)]
        while open_:
            n = open_.pop()
            for a, b, _ in links:
                for x, y in ((a, b), (b, a)):
                    if x == n and y in members and y not in reached:
                        reached.add(y)
                        open_.append(y)
        if reached != members or c != min(members):
            return False
    return True


def best_move(links, part, resolution):
    """Largest gain of one node's move, to a community or alone."""
    now = value(links, part, resolution)
    return max(value(links, {**part, n: c}, resolution) - now for n in part for c in [*set(part.values()), -1])


def graph(seed, n, p):
    draw = random.Random(seed)
    return [(a, b, round(draw.uniform(0.1, 1.0), 3)) for a in range(n) for b in range(a + 1, n) if draw.random() < p]


def frame(spark, links, n):
    return (spark.range(n).select(F.col("id").alias("node")),
            spark.createDataFrame(links, "a long, b long, weight double"))


def members(found):
    return {r["node"]: r["community"] for r in found.collect()}


def partitions(n):
    """Every partition as a list of group numbers."""
    def grow(prefix, used):
        if len(prefix) == n:
            yield prefix
            return
        for g in range(used + 1):
            yield from grow([*prefix, g], max(used, g + 1))
    yield from grow([], 0)


def test_a_small_graph_comes_near_the_best_partition(spark):
    links = graph(1, 8, 0.5)
    nodes, edges = frame(spark, links, 8)
    part = members(C.leiden(nodes, edges, 0.3))
    best = max(value(links, dict(enumerate(p)), 0.3) for p in partitions(8))
    assert connected(links, part)
    assert value(links, part, 0.3) >= 0.95 * best
    assert best_move(links, part, 0.3) < 1e-6


def test_quality_never_falls_and_no_move_improves_the_result(spark, monkeypatch):
    links = graph(11, 30, 0.2)
    nodes, edges = frame(spark, links, 30)
    seen, moved = [], C._moved

    def watched(state, moves, merging):
        after = C.cut_lineage(moved(state, moves, merging))
        part = {r["node"]: r["comm"] for r in after.collect()}
        if not merging and len(part) == 30:
            seen.append(value(links, part, 0.2))
        return after

    monkeypatch.setattr(C, "_moved", watched)
    found = C.leiden(nodes, edges, 0.2, seed=3)
    part = members(found)
    seen.append(value(links, part, 0.2))
    assert len(seen) > 2 and all(a <= b + 1e-9 for a, b in zip(seen, seen[1:]))
    assert len(part) == 30 and connected(links, part)
    assert best_move(links, part, 0.2) < 1e-6
    assert C.quality(edges, found, 0.2) == pytest.approx(seen[-1])


def test_cliques_hubs_and_awkward_rows(spark):
    cliques = [(a, b, 1.0) for base in (0, 10, 20) for a in range(base, base + 5) for b in range(a + 1, base + 5)]
    bridges = [(4, 10, 0.1), (14, 20, 0.1)]
    odd = [(7, 7, 5.0), (None, 3, 1.0), (3, None, 1.0), (0, 10, -4.0), (1, 999, 9.0), (2, 11, float("nan"))]
    doubled = [(b, a, w) for a, b, w in cliques[:3]]
    edges = spark.createDataFrame(cliques + bridges + odd + doubled, "a long, b long, weight double")
    ids = [*range(0, 5), *range(10, 15), *range(20, 25), 7, 7, None]
    nodes = spark.createDataFrame([(i,) for i in ids], "node long")
    part = members(C.leiden(nodes, edges, 0.5))
    assert part == {**{i: i // 10 * 10 for i in ids if i is not None and i != 7}, 7: 7}
    star = spark.createDataFrame([(0, i, 1.0) for i in range(1, 50)], "a long, b long, weight double")
    alone = members(C.leiden(spark.range(50).withColumnRenamed("id", "node"), star, 0.001))
    assert set(alone.values()) == {0}


def test_rounds_run_only_over_parts_that_may_end_divided(spark, monkeypatch):
    links = [
        (0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0), (0, 2, 0.01),  # 4 pairs at 0.1 across a cut of the chain
        (10, 11, 0.9), (11, 12, 0.9), (10, 12, 0.9), (3, 10, 0.09), (3, 12, 0.09),
        (20, 21, 0.3), (21, 22, 0.3), (22, 23, 0.3), (23, 24, 0.3), (12, 20, 0.05),  # 6 pairs at 0.1
        (30, 31, 0.05)]
    ids = [*range(4), 10, 11, 12, *range(20, 25), 30, 31]
    nodes, edges = spark.createDataFrame([(i,) for i in ids], "node long"), frame(spark, links, 1)[1]
    seen, settle = set(), C._settle

    def watched(points, *args, **options):
        seen.update(r["node"] for r in points.collect())
        return settle(points, *args, **options)

    monkeypatch.setattr(C, "_settle", watched)
    part = members(C.leiden(nodes, edges, 0.1))
    assert seen == set(range(20, 25))
    want = {**dict.fromkeys(range(4), 0), **dict.fromkeys((10, 11, 12), 10), 30: 30, 31: 31}
    assert {n: c for n, c in part.items() if n not in seen} == want
    assert connected(links, part) and best_move(links, part, 0.1) < 1e-6
    points = nodes.withColumn("size", F.lit(1.0))
    assert members(C._rounds(points, C._links(points, edges), 0.1, 0).withColumnRenamed("comm", "community")) == part


def test_a_part_at_the_bound_goes_through_the_rounds(spark):
    def whole(n, weight, resolution):
        chain = [(k, k + 1, weight) for k in range(n - 1)]
        nodes, edges = frame(spark, chain, n)
        return {r["whole"] for r in C._parts(nodes, C._links(nodes, edges), resolution).collect()}

    assert whole(4, 1.0, 0.25) == {False}
    assert whole(4, 1.0, 0.2499) == {True}
    assert whole(633, 1.0, 1e-5) == {False} and whole(632, 1.0, 1e-5) == {True}


def test_orders_of_a_year_need_no_rounds(spark, tmp_path, monkeypatch):
    rows = [(c * 100 + (7 * k) % 23, c, f"{1992 + k // 8}-0{1 + k % 8}-01") for c in range(3) for k in range(23)]
    rows += [(900, None, "1992-01-01"), (901, 4, None), (901, 4, None)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, day string")
    orders.select("o_orderkey", "o_custkey", F.to_timestamp("day").alias("o_orderdate")).write.parquet(
        f"{tmp_path}/orders.parquet")

    def none(*args, **options):
        raise AssertionError("a round")

    monkeypatch.setattr(C, "_settle", none)
    groups = {}
    for key, customer, day in rows:
        groups.setdefault((customer, day and day[:4]), set()).add(key)
    want = {key: min(keys) for keys in groups.values() for key in keys}
    assert members(CATALOG["leiden_orders"][0](spark, str(tmp_path))) == want


def test_empty_graphs(spark):
    nodes, edges = frame(spark, [], 3)
    assert members(C.leiden(nodes, edges)) == {0: 0, 1: 1, 2: 2}
    assert members(C.leiden(nodes.limit(0), edges)) == {}


def test_consensus_keeps_what_most_runs_share(spark):
    links = [(a, b, 1.0) for base in (0, 4) for a in range(base, base + 4) for b in range(a + 1, base + 4)]
    nodes, edges = frame(spark, [*links, (3, 4, 0.2)], 9)
    assert members(C.consensus(nodes, edges, 0.5, runs=2)) == {**{i: i // 4 * 4 for i in range(8)}, 8: 8}


def test_registered_query_over_columns(spark, small):
    links = [(r["a"], r["b"], r["weight"]) for r in CATALOG["knn_graph"][0](spark, small).collect()]
    part = members(CATALOG["leiden_knn"][0](spark, small))
    links = [x for x in links if x[2] > 0]
    assert len(part) == 64 and connected(links, part)
    assert best_move(links, part, 0.001) < 1e-6
