"""Near-duplicate groups by b-bit MinHash.

Every document's set of five-word shingles gets 200 minima. The low bits of all minima are packed
into a signature; five minima at a time form one of 40 band keys, so a pair at similarity 0.75 meets
in a band but for one case in 50,000. Documents of equal sets are one class from the start. Within a
bucket each class is first held against the bucket's smallest one; what these links leave apart is
compared block by block on signatures (collision-corrected estimate, five standard deviations of
slack) and then on full sets. Every link is confirmed on full sets.

A class with a third of all rows is aggregated before the shuffle; a bucket of any size is split
into blocks, each pair of blocks being one small group. Only links between parts that are not yet
joined leave a task, so their number stays near that of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.llm import sieve, textscan
from colsieve.llm.store import cut_lineage, small_batches, unused
from colsieve.operators.graph import components

WIDTH = 5
SHARE = 75  # percent of the union that the intersection must reach
BANDS, ROWS, BITS = 40, 5, 2
BLOCK = 512  # classes of a bucket compared at once
_FIELDS = 64 // BITS
_WORDS = -(-BANDS * ROWS // _FIELDS)
_LOW = np.uint64(sum(1 << (BITS * i) for i in range(_FIELDS)))
_random = np.random.default_rng(7541)
_FACTORS = _random.integers(1, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)


def shingle_sets(part: textscan.Slice, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every document, sorted, and bounds per document."""
    starts, ends, bounds = textscan.windows(part, width)
    return textscan.distinct(textscan.segment_hash(part.hashes(), starts, ends), bounds)


def minima(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of minima for every document; each must have a shingle."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), len(_FACTORS)), np.uint32)
    for k, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS, strict=True)):
        out[:, k] = np.minimum.reduceat(values * factor + shift, starts)
    return out


def pack(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima, a few 64-bit words for each document."""
    fields = np.zeros((len(least), _WORDS * _FIELDS), np.uint64)
    fields[:, : least.shape[1]] = least & np.uint32((1 << BITS) - 1)
    places = np.arange(_FIELDS, dtype=np.uint64) * np.uint64(BITS)
    return (fields.reshape(len(least), _WORDS, _FIELDS) << places).sum(axis=2, dtype=np.uint64)


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimated similarity of every left signature with every right one, chance matches taken off."""
    differing = np.zeros((len(left), len(right)), np.int32)
    for word in range(_WORDS):
        x = left[:, None, word] ^ right[None, :, word]
        for bit in range(1, BITS):
            x = x | (x >> np.uint64(bit))
        differing += np.bitwise_count(x & _LOW)
    chance = 0.5**BITS
    return (1.0 - differing / (BANDS * ROWS) - chance) / (1.0 - chance)


def slack() -> float:
    """The estimate below which a pair at the limit falls once in some millions."""
    chance = 0.5**BITS
    match = chance + (1 - chance) * SHARE / 100
    return SHARE / 100 - 5 * (match * (1 - match) / (BANDS * ROWS)) ** 0.5 / (1 - chance)


_PROFILE = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
    ("signature", pa.binary()), ("bands", pa.list_(pa.int64())),
])


def _fingerprints(shingles: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two hashes of every set; 0 of the empty one."""
    full = np.flatnonzero(np.diff(bounds))
    out = [np.zeros(len(bounds) - 1, np.uint64) for _ in range(2)]
    if len(full):
        for held, salt in zip(out, (0xA5A5, 0x5A5A5A)):
            held[full] = np.add.reduceat(textscan.mix(shingles, salt), bounds[:-1][full])
    return out


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for part in textscan.slices(batch.column(1)):
            shingles, bounds = shingle_sets(part)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            first, second = _fingerprints(shingles, bounds)
            signatures, bands = np.zeros((0, _WORDS), np.uint64), np.zeros((0, BANDS), np.uint64)
            if len(full):
                at = bounds[:-1][full]
                least = minima(shingles, at)
                signatures = pack(least)
                rows = least.reshape(len(full) * BANDS, ROWS).astype(np.uint64).ravel()
                ends = np.arange(ROWS, len(rows) + 1, ROWS)
                keys = textscan.segment_hash(textscan.mix(rows), ends - ROWS, ends).reshape(-1, BANDS)
                bands = textscan.mix(keys ^ np.arange(1, BANDS + 1, dtype=np.uint64))
            counts = (sizes > 0).astype(np.int64)
            steps = np.concatenate(([0], np.cumsum(counts)))
            yield pa.RecordBatch.from_arrays([
                ids.slice(part.first, part.count), pa.array(sizes.astype(np.int64)),
                textscan.int64(first), textscan.int64(second),
                textscan.binary(signatures.ravel(), steps * _WORDS),
                textscan.large_list(textscan.int64(bands.ravel()), steps * BANDS),
            ], schema=_PROFILE)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("first_id", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    for batch in batches:
        for part in textscan.slices(batch.column(1)):
            shingles, bounds = shingle_sets(part)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(part.first, part.count), *map(textscan.int64, _fingerprints(shingles, bounds)),
                textscan.large_list(textscan.int64(shingles), bounds),
            ], schema=schema)


class _Forest:
    """Union-find over the members of one comparison."""

    def __init__(self, labels: np.ndarray):
        self.parent: dict[int, int] = {}
        self.labels = labels.tolist()

    def root(self, k: int) -> int:
        node = self.labels[k]
        while (up := self.parent.get(node, node)) != node:
            node = up
        return node

    def join(self, a: int, b: int) -> None:
        self.parent[self.root(a)] = self.root(b)


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < SHARE * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= SHARE * (len(a) + len(b) - common)


def _compare(rows: list[tuple], crossing: bool) -> list[tuple[int, int]]:
    """Links that join parts not yet joined; of crossing blocks only those from one to the other."""
    ids = [r[3] for r in rows]
    labels = np.array([r[4] for r in rows], np.int64)
    signatures = np.frombuffer(b"".join(r[5] for r in rows), np.uint64).reshape(len(rows), _WORDS)
    forest, found = _Forest(labels), []
    near = estimate(signatures, signatures) >= slack()
    near &= labels[:, None] != labels[None, :]
    if crossing:
        side = np.array([r[7] for r in rows])
        near &= side[:, None] != side[None, :]
    for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        if forest.root(a) != forest.root(b) and _linked(rows[a][6], rows[b][6]):
            forest.join(a, b)
            found.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
    return found


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (key, bi, bj); a group is at most two blocks."""
    schema = pa.schema([("i", pa.int64()), ("j", pa.int64())])

    def flush(rows):
        pairs = _compare(rows, rows[0][1] != rows[0][2]) if len(rows) > 1 else []
        if pairs:
            left, right = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], schema=schema)

    group: list[tuple] = []
    for batch in batches:
        sets = batch.column(6)
        values = sets.flatten().to_numpy(zero_copy_only=False)
        bounds = np.concatenate(([0], np.cumsum(sets.value_lengths().to_numpy(zero_copy_only=False))))
        plain = [batch.column(k).to_pylist() for k in (0, 1, 2, 3, 4, 5, 7)]
        for n, (key, bi, bj, rep, label, signature, block) in enumerate(zip(*plain, strict=True)):
            if group and group[0][:3] != (key, bi, bj):
                yield from flush(group)
                group = []
            shingles = values[bounds[n]: bounds[n + 1]].copy()
            group.append((key, bi, bj, rep, label, signature, shingles, block))
    if group:
        yield from flush(group)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (i, j) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("i"), F.col("shingles").alias("left"))
    right = sets.select(F.col("rep").alias("j"), F.col("shingles").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    return pairs.join(right, "j").join(left, "i").withColumn("common", common).filter(
        100 * F.col("common") >= SHARE * (F.size("left") + F.size("right") - F.col("common"))
    ).select("i", "j")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for every row of ``docs(doc_id, text)``.

    Words are lower-cased A-Z; a text of fewer than five words is one shingle. Null, empty and
    wordless texts have no shingle and stand alone, as do rows without doc_id (component null, kept).
    Rows that share a doc_id are each looked at; they link through that id. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = cut_lineage(docs.mapInArrow(
        _profile, "doc_id long, n_shingles long, f1 long, f2 long, signature binary, bands array<long>"
    ))
    filled = profile.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(filled.groupBy("f1", "f2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min_by("signature", "doc_id").alias("signature"),
        F.min_by("bands", "doc_id").alias("bands"),
    ))
    classes, ties = _told_apart(filled, classes)
    placed = classes.select("rep", F.explode("bands").alias("key"))
    buckets = cut_lineage(placed.groupBy("key").agg(
        F.min("rep").alias("least"), F.max("rep").alias("most"), F.count("*").alias("n")
    ).filter("least < most"))
    large = buckets.filter("n > 2")
    members = cut_lineage(placed.join(large, "key").select("key", "rep", "least", "n").distinct())
    stars = cut_lineage(
        buckets.filter("n = 2").select(F.col("least").alias("i"), F.col("most").alias("j"))
        .unionByName(members.filter("rep <> least").select(F.col("least").alias("i"), F.col("rep").alias("j")))
        .distinct()
    )
    wanted = cut_lineage(stars.select(F.explode(F.array("i", "j")).alias("rep")).distinct())
    asked = classes.join(wanted, "rep", "left_semi").select("first_id", "f1", "f2", "n_shingles", "rep")
    ids = cut_lineage(asked.select(F.col("first_id").alias("doc_id")).distinct())
    sets = cut_lineage(
        sieve.split(docs, "doc_id", ids)[1].join(ids, "doc_id", "left_semi").mapInArrow(
            _sets, "first_id long, f1 long, f2 long, shingles array<long>")
        .join(asked, ["first_id", "f1", "f2"]).filter(F.size("shingles") == F.col("n_shingles"))
        .select("rep", "shingles").dropDuplicates(["rep"])
    )
    links = cut_lineage(_confirmed(stars, sets))
    nodes, among = classes.select(F.col("rep").alias("i")), wanted.select(F.col("rep").alias("i"))
    if ties is not None:
        links = links.unionByName(ties)
        among = among.unionByName(ties.select(F.explode(F.array("i", "j")).alias("i"))).distinct()
    labels = cut_lineage(components(among, links))
    more = cut_lineage(_leftover(members, labels, classes, sets))
    if not more.isEmpty():
        labels = components(nodes, links.unionByName(more))
    placed = classes.select("f1", "f2", "n_shingles", "rep", "first_id").join(
        labels.select(F.col("i").alias("rep"), "component"), "rep", "left")
    if ties is not None:  # a component's name is its smallest id, not the number of a class
        placed = cut_lineage(placed)
        least = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("first_id").alias("least"))
        placed = placed.join(least, "component", "left").withColumn("component", F.col("least"))
    named = placed.select("f1", "f2", "n_shingles", F.coalesce("component", "first_id").alias("component_id"))
    return profile.select("doc_id", "n_shingles", "f1", "f2").join(
        named, ["f1", "f2", "n_shingles"], "left"
    ).withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    ).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def _told_apart(filled: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Classes with a number ``rep`` of their own, and the links between those that share an id.

    A class is numbered by ``first_id``, its smallest id; where several classes have the same one, as
    an id came with different texts, all but the first are numbered by a hash.
    """
    plain = classes.withColumn("first_id", F.col("rep"))
    which = F.struct("f1", "f2", "n_shingles")
    shared = cut_lineage(filled.groupBy("doc_id").agg(F.min(which).alias("low"), F.max(which).alias("high")).filter("low < high").select("doc_id"))
    if shared.isEmpty():
        return plain, None
    first = classes.groupBy("rep").agg(F.min(which).alias("first"))
    own = F.when(which == F.col("first"), F.col("rep")).otherwise(F.xxhash64("f1", "f2", "n_shingles", "rep"))
    told = cut_lineage(plain.join(first, "rep").withColumn("rep", own).drop("first"))
    tied = cut_lineage(filled.join(shared, "doc_id", "left_semi").select("doc_id", "f1", "f2", "n_shingles").distinct().join(
        told.select("f1", "f2", "n_shingles", "rep"), ["f1", "f2", "n_shingles"]).select("doc_id", "rep"))
    least = tied.groupBy("doc_id").agg(F.min("rep").alias("i"))
    return told, cut_lineage(tied.join(least, "doc_id").filter("rep <> i").select("i", F.col("rep").alias("j")).distinct())


def _leftover(members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes of a bucket that the bucket's first class leaves apart."""
    labelled = members.join(labels.select(F.col("i").alias("rep"), F.col("component").alias("label")), "rep")
    open_keys = labelled.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    ).filter("low < high").select("key")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    dealt = labelled.join(open_keys, "key", "left_semi").withColumn("block", mine).select(
        "key", "rep", "label", "block", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    full = dealt.join(classes.select("rep", "signature").dropDuplicates(["rep"]), "rep").join(sets, "rep")
    return full.select(
        "key", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
        "rep", "label", "signature", "shingles", "block",
    ).repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj").mapInArrow(
        _compare_blocks, "i long, j long"
    ).distinct()


def _least(column: str, docs: DataFrame) -> Column:
    """The smallest of some structs of all columns; by their JSON where maps have no order."""
    ordered = not any("map<" in kind or "variant" in kind for _, kind in docs.dtypes)
    return F.min(column) if ordered else F.min_by(column, F.to_json(column))


def keep_one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group; of repeated rows one stays.

    Rows without doc_id stay. Every column of ``docs`` is kept.
    """
    decided = near_duplicates(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    key, order = unused(docs, "kept_id"), unused(docs, "kept_order")
    special = cut_lineage(decided.filter("NOT kept OR n > 1").select(F.col("doc_id").alias(key), "kept"))
    # rows of other ids, nearly all, stay where they are
    single, open_ = sieve.split(docs, "doc_id", special.select(key))
    same = F.col("doc_id") == F.col(key)
    single = single.unionByName(open_.join(special.select(key), same, "left_anti"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    first = open_.join(special.filter("kept").select(key), same, "left_semi").withColumn(
        order, F.struct(*columns)).groupBy("doc_id").agg(_least(order, docs).alias(order))
    return single.unionByName(first.select(*[F.col(order).getField(c).alias(c) for c in docs.columns]))
