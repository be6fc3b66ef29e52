"""Communities of a weighted graph: Leiden rounds on the constant Potts model as joins and sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.operators.graph import components
from colsieve.session import cut_lineage

LEAST_GAIN = 1e-9


def leiden(
    nodes: DataFrame, edges: DataFrame, resolution: float = 0.1, seed: int = 0, node: str = "node",
) -> DataFrame:
    """Communities that no node's move improves: ``(node, community)``.

    ``edges`` has a, b, weight and is undirected. The quality is the weight inside communities
    less ``resolution`` times the pairs of nodes inside them. A pass lets nodes move, merges nodes
    anew inside each community, makes a graph of what was merged, and goes on there until nothing
    merges; passes repeat from the result until no node moves. Quality never falls, every community is
    connected and named after its smallest node. A quarter of the nodes, drawn by ``seed``, waits in the
    first round of moves. Parts of the graph that can only end as one community need no rounds, see ``_parts``.

    Parallel edges add up. Loops, edges of weights that are not above 0, null ends and ends that are not in
    ``nodes`` are left out; repeated nodes count once. A node without edges is a community.
    """
    points = cut_lineage(
        nodes.select(F.col(node).cast("long").alias("node")).filter("node IS NOT NULL").distinct()
        .withColumn("size", F.lit(1.0)))
    links = cut_lineage(_links(points, edges))
    parts = cut_lineage(_parts(points, links, resolution))
    found = parts.filter("whole").select("node", F.col("part").alias("comm"))
    rest = parts.filter("NOT whole").select("node", F.col("part").alias("comm"))
    if not rest.isEmpty():
        points = cut_lineage(points.join(rest.select("node"), "node", "left_semi"))
        found = found.unionByName(_rounds(points, cut_lineage(_inside(links, rest)), resolution, seed))
    return found.select(F.col("node").alias(node), F.col("comm").alias("community"))


def _parts(points: DataFrame, links: DataFrame, resolution: float) -> DataFrame:
    """What links as heavy as the resolution connect, and whether moves end with all of it as one community.

    Lighter links between two parts never hold nodes together: any group in one and any in the other have
    less weight between them than ``resolution`` times their pairs, so no node gains by crossing.

    A part of n nodes has at most n² / 4 pairs between two groups. Where each of its heavy links outweighs
    ``resolution`` times these, joining two groups that one links always gains: rounds that end
    while the part is divided would leave a move that gains, so they end with the whole part. Lighter links
    inside it only add to that.
    """
    heavy = links.filter(F.col("weight") >= resolution - LEAST_GAIN)
    part = components(points.select("node"), heavy.select(F.col("a").alias("i"), F.col("b").alias("j")), "node")
    weakest = heavy.groupBy(F.col("a").alias("node")).agg(F.min("weight").alias("weight"))
    placed = cut_lineage(part.withColumnRenamed("component", "part").join(weakest, "node", "left"))
    pairs = F.floor(F.col("n") * F.col("n") / 4)
    # Weights are rounded to nine places in the rounds; the margins are wider than that.
    sure = F.col("weight") * (1 - 1e-9) > resolution * pairs + 10 * LEAST_GAIN
    whole = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("weight").alias("weight")).select(
        "part", ((F.col("n") == 1) | (F.lit(resolution >= 0) & sure)).alias("whole"))
    return placed.select("node", "part").join(whole, "part")


def _rounds(points: DataFrame, links: DataFrame, resolution: float, seed: int) -> DataFrame:
    """Passes until no node moves: ``(node, comm)``."""
    found = points.select("node", F.col("node").alias("comm"))
    while True:
        settled = _settle(points, links, found, resolution, seed)
        if settled is found:
            return found
        found = _connected_parts(links, _one_pass(points, links, settled, resolution, seed))


def _connected_parts(links: DataFrame, found: DataFrame) -> DataFrame:
    """Each community's connected parts, named after their smallest node; no split costs quality."""
    inside = _inside(links, found).select(F.col("a").alias("i"), F.col("b").alias("j"))
    return cut_lineage(components(found.select(F.col("node").alias("i")), inside).select(
        F.col("i").alias("node"), F.col("component").alias("comm")))


def consensus(
    nodes: DataFrame, edges: DataFrame, resolution: float = 0.1, runs: int = 5, seed: int = 0,
    node: str = "node",
) -> DataFrame:
    """Communities over several runs: what edges whose ends share one in over half the runs connect.

    Agreement is counted per edge, never per pair of nodes, so its size is that of the graph.
    """
    kept = None
    for k in range(runs):
        found = leiden(nodes, edges, resolution, seed + 1000 * k, node=node).select(
            F.col(node).alias("node"), F.col("community").alias("comm"))
        shared = _inside(edges, found).select("a", "b").distinct()
        kept = shared if kept is None else kept.unionByName(shared)
    agreed = kept.groupBy("a", "b").count().filter(F.col("count") * 2 > runs)
    every = nodes.select(F.col(node).cast("long").alias("i")).filter("i IS NOT NULL").distinct()
    return components(every, agreed.select(F.col("a").alias("i"), F.col("b").alias("j"))).select(
        F.col("i").alias(node), F.col("component").alias("community"))


def quality(edges: DataFrame, found: DataFrame, resolution: float, node: str = "node") -> float:
    """Weight inside communities less ``resolution`` times the pairs of nodes inside them."""
    placed = found.select(F.col(node).alias("node"), F.col("community").alias("comm"))
    weight = _inside(_links(placed.select("node"), edges), placed).agg(F.coalesce(F.sum("weight"), F.lit(0.0))).scalar()
    pairs = placed.groupBy("comm").agg(F.count("*").cast("double").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0))).scalar()
    row = found.sparkSession.range(1).select(weight.alias("w"), pairs.alias("p")).first()
    return row["w"] - resolution * row["p"]


def _links(points: DataFrame, edges: DataFrame) -> DataFrame:
    ends = edges.select(
        F.least(F.col("a").cast("long"), F.col("b").cast("long")).alias("a"),
        F.greatest(F.col("a").cast("long"), F.col("b").cast("long")).alias("b"),
        F.col("weight").cast("double").alias("weight"), F.col("a").isNull().alias("open"), F.col("b").isNull().alias("loose"),
    ).filter("NOT open AND NOT loose AND a <> b AND weight > 0 AND NOT isnan(weight)")
    known = points.select("node")
    return (
        ends.groupBy("a", "b").agg(F.sum("weight").alias("weight"))
        .join(known.withColumnRenamed("node", "a"), "a", "left_semi")
        .join(known.withColumnRenamed("node", "b"), "b", "left_semi").select("a", "b", "weight")
    )


def _inside(links: DataFrame, found: DataFrame) -> DataFrame:
    """Links whose ends share a community."""
    left = found.select(F.col("node").alias("a"), F.col("comm").alias("comm_a"))
    right = found.select(F.col("node").alias("b"), F.col("comm").alias("comm_b"))
    return links.join(left, "a").join(right, "b").filter("comm_a = comm_b").drop("comm_a", "comm_b")


def _one_pass(points: DataFrame, links: DataFrame, found: DataFrame, resolution: float, seed: int) -> DataFrame:
    """Merges inside settled communities, moves on the graph of the merged, until nothing merges."""
    whole = points.select("node", F.col("node").alias("vertex"))
    while True:
        merged = None if _all_alone(found) else _merge_inside(points, links, found, resolution, seed)
        if merged is None or _all_alone(merged):
            return cut_lineage(
                whole.join(found.withColumnRenamed("node", "vertex"), "vertex").select("node", "comm"))
        whole = cut_lineage(
            whole.join(merged.select(F.col("node").alias("vertex"), F.col("comm").alias("next")), "vertex")
            .select("node", F.col("next").alias("vertex")))
        # A merged group lies in one community, which is where the next round starts.
        grown = cut_lineage(
            points.join(merged, "node").join(found.withColumnRenamed("comm", "held"), "node")
            .groupBy("comm").agg(F.sum("size").alias("size"), F.min("held").alias("held")))
        points = grown.select(F.col("comm").alias("node"), "size")
        start = grown.select(F.col("comm").alias("node"), F.col("held").alias("comm"))
        left = merged.select(F.col("node").alias("a"), F.col("comm").alias("group_a"))
        right = merged.select(F.col("node").alias("b"), F.col("comm").alias("group_b"))
        links = cut_lineage(
            links.join(left, "a").join(right, "b").filter("group_a <> group_b")
            .groupBy(F.least("group_a", "group_b").alias("a"), F.greatest("group_a", "group_b").alias("b"))
            .agg(F.sum("weight").alias("weight")))
        found = _settle(points, links, start, resolution, seed)


def _all_alone(found: DataFrame) -> bool:
    return found.groupBy("comm").count().filter("count > 1").isEmpty()


def _merge_inside(points: DataFrame, links: DataFrame, found: DataFrame, resolution: float, seed: int) -> DataFrame:
    """Groups of nodes inside each community, grown from single nodes; they never cross it."""
    totals = points.join(found, "node").groupBy("comm").agg(F.sum("size").alias("around"))
    bounded = cut_lineage(points.join(found, "node").join(totals, "comm").select("node", "size", "around"))
    single = points.select("node", F.col("node").alias("comm"))
    return _settle(bounded, cut_lineage(_inside(links, found)), single, resolution, seed, merging=True)


def _settle(
    points: DataFrame, links: DataFrame, comm: DataFrame, resolution: float, seed: int, merging: bool = False,
) -> DataFrame:
    """Rounds of simultaneous moves until no node gains by one: ``(node, comm)``."""
    placed = points.join(comm, "node")
    totals = placed.groupBy("comm").agg(F.sum("size").alias("total"))
    state = cut_lineage(placed.join(totals, "comm"))
    step = 0
    while True:
        offers = cut_lineage(_offers(state, links, resolution, seed, step, merging))
        if offers.isEmpty():
            return comm if step == 0 else state.select("node", "comm")
        if step == 0:
            offers = offers.filter(F.pmod("tie", F.lit(4)) > 0)
        state = cut_lineage(_moved(state, _accepted(offers, resolution), merging))
        step += 1


def _offers(
    state: DataFrame, links: DataFrame, resolution: float, seed: int, step: int, merging: bool,
) -> DataFrame:
    """Each node's best move that gains, alone or to a neighbouring community.

    When merging, only nodes that are still alone move, and only where both sides hold to the rest of
    the surrounding community by at least ``resolution`` times the pairs between.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
    there = state.select(F.col("node").alias("b"), F.col("comm").alias("near"), F.col("total").alias("near_total"))
    near = both.join(there, "b").groupBy(F.col("a").alias("node"), "near", "near_total").agg(
        F.round(F.sum("weight"), 9).alias("w"))
    pulls = near.join(state, "node")
    if merging:
        cut = pulls.filter("near <> comm").groupBy("comm", "total", "around").agg(F.sum("w").alias("cut"))
        held = cut.filter(
            F.col("cut") + LEAST_GAIN >= resolution * F.col("total") * (F.col("around") - F.col("total"))
        ).select("comm")
        pulls = pulls.filter("total = size").join(held, "comm", "left_semi").join(
            held.withColumnRenamed("comm", "near"), "near", "left_semi")
    away = F.col("near") != F.col("comm")
    value = F.col("w") - resolution * F.col("size") * F.col("near_total")
    best = pulls.groupBy("node", "size", "comm", "total").agg(
        F.max(F.when(away, F.struct(value.alias("value"), _tie("near", seed).alias("tie"), "near"))).alias("best"),
        F.coalesce(F.sum(F.when(~away, F.col("w"))), F.lit(0.0)).alias("inside"),
    )
    leave = resolution * F.col("size") * (F.col("total") - F.col("size")) - F.col("inside")
    can_leave = F.lit(False) if merging else F.col("total") > F.col("size")
    alone = can_leave & (F.col("best").isNull() | (F.col("best.value") < 0))
    return best.filter(alone | F.col("best").isNotNull()).select(
        "node", "size", _key(F.col("comm"), F.lit(False)).alias("source"),
        F.when(alone, _key(F.col("node"), F.lit(True))).otherwise(
            _key(F.col("best.near"), F.lit(False))).alias("target"),
        F.round(leave + F.when(alone, F.lit(0.0)).otherwise(F.col("best.value")), 9).alias("gain"),
        F.xxhash64("node", F.lit(seed), F.lit(step)).alias("tie"),
    ).filter(F.col("gain") > LEAST_GAIN)


def _tie(column: str, seed: int) -> Column:
    return F.xxhash64(F.col(column), F.lit(seed))


def _key(comm: Column, fresh: Column) -> Column:
    """A community, or the new one that a node founds."""
    return F.struct(comm.alias("comm"), fresh.alias("fresh"))


def _accepted(offers: DataFrame, resolution: float) -> DataFrame:
    """Moves whose gains hold together.

    The best move that touches a community decides whether it gives or takes nodes this round, so none
    does both. Moves that share a community can only cost each other ``resolution`` times the
    product of their sizes. A move that is the best of both its communities stands; any other stands if
    it gains more than its share: half of these products, and the whole of those with a best one.
    The best of all always stands, and gains add up to more than the costs.
    """
    rank = F.struct("gain", "tie", "node")

    def sides(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.explode(F.array(
                F.struct(F.col("source").alias("key"), F.lit(False).alias("takes")),
                F.struct(F.col("target").alias("key"), F.lit(True).alias("takes")))).alias("side"),
            rank.alias("rank"), "size",
        ).select("side.*", "rank", "size")

    roles = sides(offers).groupBy("key").agg(F.max_by("takes", "rank").alias("takes"))
    giving = roles.filter("NOT takes").select(F.col("key").alias("source"))
    taking = roles.filter("takes").select(F.col("key").alias("target"))
    open_moves = offers.join(giving, "source", "left_semi").join(taking, "target", "left_semi")
    crowds = sides(open_moves).groupBy("key").agg(F.sum("size").alias("crowd"), F.max(F.struct("rank", "size")).alias("top"))
    out = crowds.select(F.col("key").alias("source"), F.col("crowd").alias("leaving"), F.col("top").alias("top_out"))
    into = crowds.select(F.col("key").alias("target"), F.col("crowd").alias("coming"), F.col("top").alias("top_in"))

    def share(crowd: str, top: str) -> Column:
        best = F.col(top)
        whole = F.when(best["rank"]["node"] == F.col("node"), F.lit(0.0)).otherwise(best["size"])
        return (F.col(crowd) - F.col("size") + whole) / 2

    first = lambda top: F.col(top)["rank"]["node"] == F.col("node")
    return open_moves.join(out, "source").join(into, "target").filter(
        (F.col("gain") > resolution * F.col("size") * (share("leaving", "top_out") + share("coming", "top_in")))
        | (first("top_out") & first("top_in"))
    ).select("node", "target")


def _moved(state: DataFrame, moves: DataFrame, merging: bool) -> DataFrame:
    """Membership and sizes after the moves; communities get the name of their smallest node.

    When merging, names stay, as the node that gave one never leaves.
    """
    after = state.drop("total").join(moves, "node", "left").withColumn(
        "key", F.coalesce("target", _key(F.col("comm"), F.lit(False)))).drop("target", "comm")
    name = F.first("key.comm") if merging else F.min("node")
    totals = after.groupBy("key").agg(name.alias("comm"), F.sum("size").alias("total"))
    return after.join(totals, "key").drop("key")
