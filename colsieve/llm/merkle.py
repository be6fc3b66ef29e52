"""Merkle manifest of a dataset: a hash for every row, source and for the whole, with proofs.

Rows of a source ascend by doc_id; every ``FAN`` consecutive nodes become the hash of their
concatenation until one is left, the source's root; roots of the sources likewise give the root.

An aligned block of ``FAN ** STEPS`` nodes keeps each level as one hex string: fixed-width
substrings of it are the runs whose hashes form the next level, and the substrings flanking a node
in its run are its siblings. Blocks of a level are hashed on their own, and their roots are the
nodes of the next round, so a source of any size takes a few rounds. Proofs go down the same way:
a block gets the flanks above it and adds its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.llm.positions import numbered
from colsieve.llm.store import cut_lineage

FAN, STEPS, WIDTH = 16, 3, 64
BLOCK = FAN**STEPS
FLANKS = "array<struct<left:string,right:string>>"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(values: list[Column]) -> Column:
    """Hash of the values as ``-`` if null, else their UTF-8 byte count, a colon and the value."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*[field(v) for v in values]))


def _runs(level: Column) -> Column:
    """Runs of ``FAN`` nodes of a level, as strings."""
    width = FAN * WIDTH
    last = F.floor((F.length(level) - 1) / width).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda r: F.substr(level, r * width + 1, F.lit(width)))


def _with_runs(level: Column, height: Column, use) -> Column:
    """``use`` of the runs of every level below the top of a block, and of the node at its top.

    What is passed on is bound to a lambda's argument, so it is computed once for a block.
    """
    def bind(value: Column, f) -> Column:
        return F.element_at(F.transform(F.array(value), f), 1)

    def climb(step: int, level: Column, runs: list[Column]) -> Column:
        if step == STEPS:
            return use(runs, level)

        def parents(found: Column) -> Column:
            up = F.when(height > step, F.array_join(F.transform(found, digest), "")).otherwise(level)
            return bind(up, lambda above: climb(step + 1, above, [*runs, found]))

        return bind(_runs(level), parents)

    return climb(0, level, [])


def _height(n: Column) -> Column:
    """Levels that a block has below its top: all if others follow it, else until one node is left."""
    height = F.lit(STEPS)
    for step in reversed(range(STEPS)):
        height = F.when(n <= FAN**step, step).otherwise(height)
    return height


def blocks_of(nodes: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """``(keys, block, n, level, height, held, node)`` from ``(keys, position, n, node, payload)``, written.

    ``held`` are the payloads in the order of the block's nodes, ``node`` is its root.
    """
    rows = nodes.select(
        *keys, "n", F.floor(F.col("position") / BLOCK).alias("block"), F.struct("position", "node", *payload).alias("x"))
    level = F.array_join(F.transform("xs", lambda x: x["node"]), "")
    grouped = rows.groupBy(*keys, "block").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("x")).alias("xs")).select(
        *keys, "block", "n", level.alias("level"), _height(F.col("n")).alias("height"),
        F.transform("xs", lambda x: F.struct(*[x[p].alias(p) for p in ("position", *payload)])).alias("held"))
    return cut_lineage(grouped.withColumn("node", _with_runs(F.col("level"), F.col("height"), lambda _, top: top)))


def built(nodes: DataFrame, keys: list[str], payload: list[str]) -> list[DataFrame]:
    """Blocks of every round, the nodes' own first; in the last one each group is one block."""
    rounds = [blocks_of(nodes, keys, payload)]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > BLOCK:
        above = rounds[-1].select(*keys, F.col("block").alias("position"), F.ceil(F.col("n") / BLOCK).alias("n"), "node")
        rounds.append(blocks_of(above, keys, []))
    return rounds


def _flanks(runs: list[Column], height: Column, index: Column) -> Column:
    """Siblings of the node at ``index`` of a block, from its own level up."""
    found = []
    for step, run in enumerate(runs):
        at = F.floor(index / FAN**step)
        here = F.element_at(run, (F.floor(at / FAN) + 1).cast("int"))
        place = F.pmod(at, F.lit(FAN)).cast("int") * WIDTH
        pair = F.struct(F.substr(here, F.lit(1), place).alias("left"), F.substr(here, place + WIDTH + 1).alias("right"))
        found.append(pair)
    return F.slice(F.array(*found), F.lit(1), height)


def children(blocks: DataFrame, use) -> Column:
    """Array of ``use(held, node, flanks with all above them)`` for the nodes of a block; ``upper`` is a column."""
    def of_block(runs: list[Column], _: Column) -> Column:
        def node(i: Column) -> Column:
            run = F.element_at(runs[0], (F.floor(i / FAN) + 1).cast("int"))
            return F.substr(run, F.pmod(i, F.lit(FAN)) * WIDTH + 1, F.lit(WIDTH))

        return F.transform("held", lambda held, i: use(held, node(i), F.concat(_flanks(runs, F.col("height"), i), F.col("upper"))))

    return _with_runs(F.col("level"), F.col("height"), of_block)


def handed_down(rounds: list[DataFrame], keys: list[str], top: DataFrame) -> DataFrame:
    """The lowest blocks with ``upper``, the flanks above them, and ``top``'s other columns."""
    carried = [c for c in top.columns if c not in keys and c != "upper"]
    blocks = rounds[-1].join(top, keys)
    for lower in reversed(rounds[:-1]):
        proofs = blocks.select(*keys, *carried, F.explode(children(blocks, lambda held, _, flanks: F.struct(
            held["position"].alias("block"), flanks.alias("upper")))).alias("x")).select(*keys, *carried, "x.block", "x.upper")
        blocks = lower.join(cut_lineage(proofs), [*keys, "block"])
    return blocks


def folded(node: Column, flanks: Column) -> Column:
    """The root that a node and its siblings lead to."""
    return F.aggregate(flanks, node, lambda below, f: digest(F.concat(f["left"], below, f["right"])))


def manifest(leaves: DataFrame) -> DataFrame:
    """Roots and proofs of ``(doc_id, source, leaf, other)``; ``other`` is a leaf to verify instead, or null.

    Returns ``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``, one row per row.
    Sources ascend bytewise, null first; in a source rows ascend by doc_id, null first, then by leaf,
    so repeated rows are leaves side by side. An empty table gives no row. A lone node is its own
    root and its proof the hash of nothing.
    """
    keys = ["named", "src"]
    rows = cut_lineage(leaves.select(
        F.col("source").isNotNull().alias("named"), F.coalesce("source", F.lit("")).alias("src"), "doc_id", F.col("leaf").alias("node"), "other"))
    placed = numbered(rows, keys, [F.col("doc_id").asc_nulls_first(), F.col("node")])
    low = built(placed, keys, ["doc_id", "other"])
    roots = low[-1].select(F.lit(0).alias("all"), *keys, "node")
    high = built(numbered(roots, ["all"], [F.col(k) for k in keys]), ["all"], keys)
    top = high[-1].select("all", F.array().cast(FLANKS).alias("upper"), F.col("node").alias("root"))

    sources = handed_down(high, ["all"], top)
    tops = cut_lineage(sources.select("root", F.explode(children(sources, lambda held, _, flanks: F.struct(
        *[held[k].alias(k) for k in keys], flanks.alias("upper")))).alias("x")).select("root", "x.*"))
    tops = tops.join(low[-1].select(*keys, F.col("node").alias("subroot")), keys)
    blocks = handed_down(low, keys, tops)

    def proven(held: Column, leaf: Column, flanks: Column) -> Column:
        def checked(x: Column) -> Column:
            siblings = F.array_join(F.transform(x["flanks"], lambda f: F.concat(f["left"], f["right"])), "")
            return F.struct(
                held["doc_id"].alias("doc_id"), x["leaf"].alias("leaf"), digest(siblings).alias("proof_sha256"),
                folded(F.coalesce(held["other"], x["leaf"]), x["flanks"]).alias("folded_root"))

        return F.element_at(F.transform(F.array(F.struct(leaf.alias("leaf"), flanks.alias("flanks"))), checked), 1)

    found = blocks.select("subroot", "root", F.explode(children(blocks, proven)).alias("x"))
    return found.select(
        "x.doc_id", "x.leaf", "subroot", "root", "x.proof_sha256", "x.folded_root", (F.col("x.folded_root") == F.col("root")).alias("verified"))


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaves of ``documents``; where ``tampered`` holds, ``other`` is the leaf of the lower-cased text."""
    plain = [F.col("doc_id").cast("long"), *[F.col(c) for c in ("source", "lang", "n_chars")]]
    text = F.col("text").cast("string")
    leaf = leaf_of([*plain, text])
    other = F.when(tampered, leaf_of([*plain, F.translate(text, UPPER, LOWER)]))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf.alias("leaf"), other.alias("other"))
