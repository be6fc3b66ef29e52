"""Mixing sources to target weights, in DataFrame operations only.

Each source's tokens lie in one stream, packed into blocks of ``BLOCK`` tokens (the last may be
shorter). A source takes whole passes over its blocks and then, along a pseudorandom permutation,
as many more blocks as its target needs; the very last is cut to the token. All slots of all
sources are dealt to the output shards by one more permutation, so the counts of sources per shard
are multinomial draws given each source's total. A permutation is a swap-or-not shuffle: a chain of
keyed involutions, computed for an index on its own, so nothing is sorted or gathered. Blocks,
documents and slots meet by block index, and the mixed shards hold the words of every slot.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colsieve.llm.store import cut_lineage, ensure_checkpoint_dir

BLOCK = 256
SHARD_SLOTS = 4096
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 2718
ROUNDS = 24
PIECE_ROWS = 20_000  # rows whose positions one window adds up
COPIES = 1000  # identical rows made by one task at a time
BITS_PER_TEXT, MOST_BITS = 16, 1 << 27  # of the bitmap of used texts; a fuller one only lets more texts pass
WORDS_AT_ONCE = 65_536  # words of identical rows whose uses lie in one list


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def permuted(index: Column, size: Column, *keys: Column, inverse: bool = False) -> Column:
    """Place of ``index`` in a permutation of 0 .. size - 1 chosen by the keys."""
    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def swap(x: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(*keys, r) - x, size)
        heads = F.pmod(F.xxhash64(*keys, r, F.greatest(x, partner)), F.lit(2)) == 1
        return F.when(heads, partner).otherwise(x)

    return F.aggregate(rounds, index.cast("long"), swap)


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``place``, the 0-based rank of ``source`` by code point, null last."""
    parted = cut_lineage(sources.repartitionByRange(F.col("source").asc_nulls_last()).select(
        "*", F.spark_partition_id().alias("part")))
    before = parted.groupBy("part").count().select(
        "part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return parted.withColumn("inside", inside).join(before, "part").select(
        *sources.columns, (F.col("before") + F.col("inside")).alias("place"))


def with_targets(sources: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size): shares by weight, capped, excess reshared.

    Sources at their cap leave; the rest share what is left by weight, until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    placed = cut_lineage(ranked(sources).withColumn("weight", weight.cast("double")))
    size, level = F.col("source_size"), 0.0
    while True:
        capped = cap * size <= level * F.col("weight")
        row = placed.agg(
            F.sum("source_size"), F.sum(F.when(capped, cap * size)), F.sum(F.when(~capped, F.col("weight"))),
            F.sum(F.when(capped, 1)),
        ).first()
        if not row[2]:
            break
        fresh = (float(row[0]) - float(row[1] or 0)) / row[2]
        if fresh <= level:
            break
        level = fresh
    target = F.least((cap * size).cast("double"), level * F.col("weight"))
    return placed.select("source", "source_size", "place", target.alias("target"))


def _sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, digest, copies)``: identical rows once, with their number."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(text).alias("size"), F.xxhash64(text, text.isNull()).alias("digest"),
    ).groupBy("doc_id", "source", "size", "digest").agg(F.count("*").alias("copies"))


def _positions(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per document row, with ``start``, its first token in its source's stream.

    A source's distinct rows are dealt by a hash to pieces of about ``PIECE_ROWS``; rows in a piece
    follow doc_id, size and digest and are added up by a window, pieces by a smaller one. So places
    depend on the rows alone, not on how they are stored. Identical rows lie side by side.
    """
    pieces = F.greatest(F.ceil(F.col("n_rows") / PIECE_ROWS), F.lit(1)).cast("int")
    dealt = sized.join(sources.select(F.col("source").alias("s"), "place", "n_rows"), F.col("source").eqNullSafe(F.col("s"))).drop(
        "s").withColumn("piece", F.pmod(F.xxhash64("doc_id", "size", "digest"), pieces).cast("int")).withColumn(
        "held", F.col("size") * F.col("copies"))
    inside = Window.partitionBy("place", "piece").orderBy("doc_id", "size", "digest").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("place").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("place", "piece").agg(F.sum("held").alias("total")).select(
        "place", "piece", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("before"))
    first = dealt.withColumn("inside", F.coalesce(F.sum("held").over(inside), F.lit(0))).join(
        before, ["place", "piece"]).withColumn("first", F.col("before") + F.col("inside"))
    # copies of a hot row are spread before they become rows of their own
    chunks = first.withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))).repartition("place", "first", "digest", "chunk")
    return chunks.withColumn("copy", F.explode(F.sequence(
        F.col("chunk") * COPIES, F.least((F.col("chunk") + 1) * COPIES, F.col("copies")) - 1))).select(
        "doc_id", "source", "place", "size", "digest", "copy", (F.col("first") + F.col("copy") * F.col("size")).alias("start"))


def slot_plan(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Slots of every source: ``(place, n_blocks, last_size, wanted, passes, more, n_slots, cut)``.

    ``wanted`` tokens are ``passes`` whole passes and ``more`` blocks of the next, in permuted order;
    ``cut`` tokens at the end of the last block are not used.
    """
    size, blocks = F.col("source_size"), F.col("n_blocks")
    plan = targets.filter("source_size > 0").select(
        "place", "source_size", F.ceil(F.col("source_size") / block).alias("n_blocks"),
        F.floor(F.col("target") + 0.5).cast("long").alias("wanted"),
    ).withColumn("last_size", size - (blocks - 1) * block).withColumn(
        "passes", F.floor(F.col("wanted") / size)
    ).withColumn("rest", F.col("wanted") - F.col("passes") * size)
    short_at = permuted(blocks - 1, blocks, F.lit(SEED), F.col("place"), F.col("passes"), inverse=True)
    plain = F.ceil(F.col("rest") / block)
    plan = plan.withColumn("short_at", short_at).withColumn("more", F.when(
        F.col("short_at") < plain, F.ceil((F.col("rest") + block - F.col("last_size")) / block)).otherwise(plain))
    held = F.col("more") * block - F.when(F.col("short_at") < F.col("more"), block - F.col("last_size")).otherwise(0)
    return plan.withColumn("cut", F.when(F.col("more") > 0, held - F.col("rest")).otherwise(0)).withColumn(
        "n_slots", F.col("passes") * blocks + F.col("more")
    ).select("place", "n_blocks", "last_size", "wanted", "passes", "more", "n_slots", "cut")


def slots(plan: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row per slot of the mix: ``(shard, slot, place, block, length)``."""
    total = plan.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    ordinals = plan.withColumn("chunk", F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / shard_slots)))
    ).filter("n_slots > 0").repartition(int(total) // (32 * shard_slots) + 1, "place", "chunk").withColumn("ordinal", F.explode(F.sequence(
        F.col("chunk") * shard_slots, F.least((F.col("chunk") + 1) * shard_slots, F.col("n_slots")) - 1)))
    offsets = plan.select("place", (F.sum("n_slots").over(Window.orderBy("place")) - F.col("n_slots")).alias("offset"))
    index = F.floor(F.col("ordinal") / F.col("n_blocks"))
    where = permuted(F.pmod("ordinal", F.col("n_blocks")), F.col("n_blocks"), F.lit(SEED), F.col("place"), index)
    length = F.when(F.col("block") == F.col("n_blocks") - 1, F.col("last_size")).otherwise(block) - F.when(
        F.col("ordinal") == F.col("n_slots") - 1, F.col("cut")).otherwise(0)
    spot = permuted(F.col("offset") + F.col("ordinal"), F.lit(max(int(total), 1)), F.lit(SEED + 1))
    return ordinals.join(offsets, "place").withColumn("block", where).withColumn("spot", spot).select(
        F.floor(F.col("spot") / shard_slots).alias("shard"), F.pmod("spot", F.lit(shard_slots)).alias("slot"),
        "place", "block", length.cast("long").alias("length"))


def shard_counts(placed: DataFrame) -> DataFrame:
    """Slots of each source in each output shard."""
    return placed.groupBy("shard", "place").agg(F.count("*").alias("n_slots"), F.sum("length").alias("tokens"))


def placed_documents(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> tuple[DataFrame, DataFrame]:
    """Document rows with their place in their source's stream, and the sources with their targets."""
    sized = cut_lineage(_sized(docs))
    sources = cut_lineage(sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_rows")))
    targets = cut_lineage(with_targets(sources.select("source", "source_size"), weights, cap))
    same = F.col("source").eqNullSafe(F.col("s"))
    counted = sources.select(F.col("source").alias("s"), "n_rows").join(targets, same).drop("s")
    return cut_lineage(_positions(sized, counted)), targets


def _identity() -> list[Column]:
    """Two hashes that tell document rows apart; equal rows share them."""
    return [F.xxhash64("source", F.col("source").isNull(), "doc_id", F.col("doc_id").isNull(), "size").alias("id"), F.col("digest")]


def _written(df: DataFrame, stem: str) -> DataFrame:
    """The table, written with zstd and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{stem}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _may_be_among(hashed: DataFrame, key: str) -> Column:
    """Whether column ``key`` may be one of the hashes: a test of one bit in a bitmap of bounded size.

    The bitmap is one row of a bounded number of words, put together by Spark; it never says no wrongly.
    """
    asked = max(1, hashed.count()) * BITS_PER_TEXT
    bits = 1 << min(int(math.log2(MOST_BITS)), max(6, math.ceil(math.log2(asked))))
    word = f"shiftright({key} & {bits - 1}L, 6)"
    one = f"shiftleft(1L, cast({key} & 63 as int))"
    every = hashed.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("one"))
    words = hashed.select(F.expr(word).alias("word"), F.expr(one).alias("one")).unionByName(every).groupBy("word").agg(F.bit_or("one").alias("one"))
    bitmap = words.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "one"))), lambda w: w["one"]).alias("bits"))
    return F.element_at(bitmap.scalar(), (F.expr(word) + 1).cast("int")).bitwiseAND(F.expr(one)) != 0


def mixed_shards(docs: DataFrame, placed: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix itself: ``(shard, slot, place, block, doc_id, start, from, to, words)``.

    A slot holds one block of a source's stream, in rows of one document each: words ``from`` up to
    ``to`` of the document that starts at ``start``, in the order of these; ``words`` is their text,
    single spaces between. Slots meet documents by block first; texts move once to their uses and
    once to their shard; texts without a use stay where they are.
    """
    dealt = slots(slot_plan(targets, block), block)
    parts = placed.filter("size > 0").select(*_identity(), "doc_id", "place", "start", "size", "copy", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    begin = F.greatest(F.col("start"), F.col("block") * block) - F.col("start")
    end = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("length")) - F.col("start")
    used = parts.join(dealt, ["place", "block"]).withColumn("from", begin).withColumn("to", end).filter("to > from")
    # one list for copies of WORDS_AT_ONCE words together, so their text is cut into words once
    uses = _written(used.groupBy("id", "digest", "doc_id", "place", F.floor(F.col("copy") * F.col("size") / WORDS_AT_ONCE).alias("group")).agg(
        F.collect_list(F.struct("shard", F.col("slot").cast("int").alias("slot"), "block", "start", F.col("from").cast("int").alias("from"),
                                F.col("to").cast("int").alias("to"))).alias("uses")), "uses")
    text = F.col("text").cast("string")
    # a text that no slot uses isn't moved
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(text, text.isNull()).alias("digest"), text.alias("text"),
    ).filter(_may_be_among(uses.select("digest"), "digest")).withColumn("size", n_words(F.col("text"))).select(*_identity(), "text").groupBy("id", "digest").agg(F.first("text").alias("text"))

    def cut(words: Column) -> Column:
        return F.transform("uses", lambda u: F.struct(
            *[u[n].alias(n) for n in ("shard", "slot", "block", "start", "from", "to")],
            F.array_join(F.slice(words, u["from"] + 1, u["to"] - u["from"]), " ").alias("words")))

    # the words are a lambda's argument: a plain column would be computed again for every use
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = F.flatten(F.transform(F.array(words), cut))
    return uses.join(texts, ["id", "digest"]).select("place", "doc_id", F.explode(rows).alias("x")).select(
        "x.shard", "x.slot", "place", "x.block", "doc_id", "x.start", "x.from", "x.to", "x.words"
    ).repartition("shard").sortWithinPartitions("shard", "slot", "start")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per row of ``docs(doc_id, text, source)``.

    The mixed shards are written, and ``taken`` counts the tokens of the document in them, repeats
    included: at most ``ceil(cap)`` times its size. A source of no words takes none. Null text has
    size 0; null is a source of its own, the last. Repeated rows are documents of their own. Other
    columns are ignored.
    """
    placed, targets = placed_documents(docs, weights, cap)
    path = f"{ensure_checkpoint_dir(docs.sparkSession)}/mixed-{uuid.uuid4().hex}"
    mixed_shards(docs, placed, targets, block).write.option("compression", "zstd").option(
        "parquet.compression.codec.zstd.level", "6").parquet(path)
    mixed = docs.sparkSession.read.parquet(path)
    taken = mixed.groupBy("place", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    # rows with words have a start of their own; those without share it with others
    filled = placed.filter("size > 0").join(taken, ["place", "start"], "left")
    empty = placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return filled.unionByName(empty, allowMissingColumns=True).join(
        targets.select("place", "source_size", "target"), "place"
    ).select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
