"""Merkle manifest against the same tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from colsieve.llm import merkle
from colsieve.llm.positions import numbered
from colsieve.llm.store import remainder_is

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def flanks(levels, at):
    for level in levels[:-1]:
        begin = at // 16 * 16
        yield "".join(level[begin:at]), "".join(level[at + 1:begin + 16])
        at //= 16


def expected(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees, held = {}, {}
    for s, group in by_source.items():
        group.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        held[s] = group
        trees[s] = tree([leaf_of(r, r["text"]) for r in group])
    whole = tree([trees[s][-1][0] for s in order])
    root, out = whole[-1][0], []
    for k, s in enumerate(order):
        for at, r in enumerate(held[s]):
            path = [*flanks(trees[s], at), *flanks(whole, k)]
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = text.translate(LOWER)
            node = leaf_of(r, text)
            for left, right in path:
                node = sha(left + node + right)
            out.append((r["doc_id"], trees[s][0][at], trees[s][-1][0], root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def got(docs):
    found = merkle.manifest(merkle.document_leaves(docs, remainder_is(F.col("doc_id"), 5, 0)))
    assert tuple(found.columns) == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_awkward_rows(awkward):
    assert got(awkward) == expected(awkward.collect())


def test_clashing_columns_change_nothing(awkward, clashing):
    assert got(clashing) == got(awkward)


def test_empty_table(no_docs):
    assert got(no_docs) == []


@pytest.mark.parametrize("rows", [1, 16, 17, 256, 257])
def test_tree_shapes(spark, rows):
    docs = spark.range(rows).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.lit("one").alias("source"), F.lit(1).alias("n_chars"))
    assert got(docs) == expected(docs.collect())


def test_a_source_of_many_blocks_and_many_sources(spark):
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") < 8500, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("source"), F.lit(1).alias("n_chars"))
    assert got(docs.repartition(7)) == expected(docs.collect())


def test_positions_of_a_hot_key_and_of_ties(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"), F.lit(1).alias("v"))
    placed = numbered(rows, ["k"], [F.col("v")]).groupBy("k").agg(
        F.count("*").alias("c"), F.countDistinct("position").alias("d"), F.min("position").alias("lo"), F.max("position").alias("hi"), F.max("n").alias("n"))
    for r in placed.collect():
        assert r["c"] == r["d"] == r["n"] == r["hi"] + 1 and r["lo"] == 0
