import pytest
from pyspark.sql import functions as F

from colsieve.llm import mixing


def shares(sizes, weights=(5, 2, 1), cap=3):
    """Targets by resharing the excess until none is above; sizes in source order."""
    total, full = sum(sizes), set()
    while True:
        open_ = [k for k in range(len(sizes)) if k not in full]
        left = total - sum(cap * sizes[k] for k in full)
        per = left / sum(weights[k % 3] for k in open_) if open_ else 0
        over = {k for k in open_ if per * weights[k % 3] > cap * sizes[k]}
        if not over:
            return [cap * s if k in full else per * weights[k % 3] for k, s in enumerate(sizes)]
        full |= over


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1000, 3, 9, 0, 50], [5], [0, 0, 7], [100, 1, 1, 1, 1, 1, 900]])
def test_targets(spark, sizes):
    rows = [(f"s{k:02d}", s) for k, s in enumerate(sizes[:-1])] + [(None, sizes[-1])]
    out = {r.source: r.target for r in mixing.with_targets(
        spark.createDataFrame(rows, "source string, source_size long")).collect()}
    assert [out[s] for s, _ in rows] == pytest.approx(shares(sizes))
    assert sum(out.values()) == pytest.approx(sum(sizes))


def test_permutations_are_permutations_with_inverses(spark):
    for size in (1, 2, 7, 100, 1021):
        rows = spark.range(size).select(
            "id", mixing.permuted(F.col("id"), F.lit(size), F.lit(3)).alias("to"),
        ).withColumn("back", mixing.permuted(F.col("to"), F.lit(size), F.lit(3), inverse=True)).collect()
        assert sorted(r.to for r in rows) == list(range(size)) and all(r.back == r.id for r in rows)
    moved = [r.to for r in rows]
    assert sum(abs(a - b) == 1 for a, b in zip(moved, moved[1:], strict=False)) < 20


@pytest.mark.parametrize("block", [1, 16, 256])
def test_takes_the_target_of_every_source_and_three_times_a_document_at_most(spark, small, block):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = mixing.mix(docs, block=block).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mix(docs.repartition(7), block=block).collect()))
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target = {}, {}
    for r in out:
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)


def test_shards_mix_their_sources(spark):
    sizes = [(0, 4000), (1, 1000), (2, 5000)]
    targets = spark.createDataFrame([(p, s, float(s)) for p, s in sizes], "place long, source_size long, target double")
    placed = mixing.slots(mixing.slot_plan(targets, 10), 10, shard_slots=200)
    assert placed.select("shard", "slot").distinct().count() == placed.count() == 1000
    counts = {(r.shard, r.place): r.n_slots for r in mixing.shard_counts(placed).collect()}
    assert all(sum(counts.get((s, p), 0) for p, _ in sizes) == 200 for s in range(5))
    assert all(40 < counts[s, 0] < 120 and 60 < counts[s, 2] < 140 for s in range(5))
    assert len({counts[s, 0] for s in range(5)}) > 1


def test_main_path_has_no_python(spark, small):
    plan = mixing.mix(spark.read.parquet(f"{small}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_awkward_rows(spark, awkward, clashing, no_docs):
    for docs in (awkward, clashing):
        out = mixing.mix(docs).collect()
        assert len(out) == docs.count()
        assert all(r.taken <= 3 * r.size for r in out) and sum(r.size == 0 for r in out) == 3
    assert mixing.mix(no_docs).count() == 0
    empty = mixing.mix(awkward.filter("doc_id IN (4, 5, 6)")).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in empty] == [(0, 0, 0.0, 0)] * 3


def test_large_sources_do_not_depend_on_partitions(spark, monkeypatch):
    """Sources of many pieces, with a hot repeated row and repeated ids on different texts."""
    monkeypatch.setattr(mixing, "PIECE_ROWS", 10)
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(k, "w " * (1 + k * 37 % 50), "ab"[k % 3 == 0]) for k in range(200)]
    rows += [(5, "hot row here", "a")] * 60 + [(7, f"same id {'x ' * k}", "b") for k in range(20)] + [(None, "no id", None), (9, "", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    outs = [sorted(map(tuple, mixing.mix(d, block=8).collect()), key=repr) for d in (
        docs.coalesce(1), docs.repartition(7), docs.orderBy("text").repartition(3))]
    assert outs[0] == outs[1] == outs[2] and len(outs[0]) == len(rows)
    assert sum(r[1] for r in outs[0]) == sum(len(r[1].split()) for r in rows)


def test_shards_hold_the_words_of_their_slots(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 4)
    monkeypatch.setattr(mixing.slots, "__defaults__", (mixing.BLOCK, 4))
    rows = [(k, " \n".join(f"d{k}w{i}" for i in range(1 + k * 13 % 40)), "ab"[k % 3 == 0]) for k in range(60)]
    rows += [(5, "same row\tthree", "b")] * 9 + [(5, "other text", "b"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed, targets = mixing.placed_documents(docs)
    out = mixing.mixed_shards(docs, placed, targets, 16).collect()
    streams = {}
    texts = {(d, len(t.split()), s): t.split() for d, t, s in rows}
    for r in placed.collect():
        for i, w in enumerate(texts[r.doc_id, r.size, r.source]):
            streams.setdefault(r.place, {})[r.start + i] = w
    want = {(r.shard, r.slot): [streams[r.place][r.block * 16 + i] for i in range(r.length)]
            for r in mixing.slots(mixing.slot_plan(targets, 16), 16).collect()}
    got = {}
    for r in sorted(out, key=lambda r: (r.shard, r.slot, r.start)):
        assert len(r.words.split()) == r.to - r["from"]
        got.setdefault((r.shard, r.slot), []).extend(r.words.split())
    assert got == want and len({s for s, _ in got}) > 3


def test_taken_comes_from_the_written_shards(spark, small, monkeypatch):
    """Without its first shard, the mix takes less."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    whole = sum(r.taken for r in mixing.mix(docs, block=1).collect())
    shards = mixing.mixed_shards
    monkeypatch.setattr(mixing, "mixed_shards", lambda *a: shards(*a).filter("shard > 0"))
    assert sum(r.taken for r in mixing.mix(docs, block=1).collect()) == whole - mixing.SHARD_SLOTS
