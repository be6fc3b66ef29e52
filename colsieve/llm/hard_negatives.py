"""Hard negatives by a vertical scan of vectors (branch and bound on decomposed data).

Vectors lie in segments that keep every dimension as a column of its own with its least and largest
value. An anchor reads the columns of a segment in the order of its descending magnitudes. After
every few columns, what the remaining ones can add at least and at most bounds each candidate's
score, and candidates that can't reach a window any more leave the bitmap. The scores of those that
stay to the last column are exact.

Anchors go round by round: a bounded number of them is sent to the tasks that scan the segments.
Tasks return a few rows per anchor, and Spark merges them. No pair of rows is ever materialised.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colsieve.llm.store import cut_lineage

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # window of a negative's score, in hundredths of the positive's
SEGMENT_ROWS = 8192
ANCHOR_BYTES = 16 << 20  # of anchors sent to the tasks in a round
COLUMNS_AT_ONCE = 8
NO_ID = np.iinfo(np.int64).max  # stands for a null id, so that it comes last
EXACT = 2.0**53

SEGMENT = "seg long, ids binary, labels array<string>, label_at array<int>, columns array<binary>, least array<double>, most array<double>, anchors binary"


def _valid(rows: DataFrame, anchor: Column) -> DataFrame:
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).filter("label IS NOT NULL AND embedding IS NOT NULL").filter(fine)


def _vertical(batch: pa.RecordBatch) -> np.ndarray:
    """Scaled components, one row per dimension; shorter vectors are filled with zeros."""
    lists = batch.column("embedding")
    sizes = np.diff(lists.offsets.to_numpy())
    flat = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((sizes.max(initial=0), len(sizes)))
    out[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), np.repeat(np.arange(len(sizes)), sizes)] = flat
    return out


def segments(rows: DataFrame, anchor: Column) -> DataFrame:
    """Rows in vertical segments, sorted by label inside, written.

    Rows with a null label, a null vector or a component that is null or not finite are left out.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seg = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        held: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            nonlocal seg
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            labels, code = np.unique(np.array(batch.column("label").to_pylist(), dtype=object), return_inverse=True)
            order = np.argsort(code, kind="stable")
            columns = _vertical(batch)[:, order]
            ids = batch.column("vec_id").fill_null(int(NO_ID)).to_numpy()[order]
            seg += 1
            return pa.RecordBatch.from_pydict({
                "seg": [seg], "ids": [ids.astype(np.int64).tobytes()], "labels": [list(labels)],
                "label_at": [np.searchsorted(code[order], np.arange(len(labels) + 1)).astype(np.int32)],
                "columns": [[c.tobytes() for c in columns]], "least": [columns.min(axis=1)], "most": [columns.max(axis=1)],
                "anchors": [batch.column("anchor").to_numpy(zero_copy_only=False)[order].tobytes()],
            }, schema=schema)

        for batch in batches:
            for at in range(0, len(batch), SEGMENT_ROWS):
                piece = batch.slice(at, SEGMENT_ROWS)
                if sum(map(len, held)) + len(piece) > SEGMENT_ROWS:
                    yield packed()
                    held.clear()
                if len(piece):
                    held.append(piece)
        if held:
            yield packed()

    text, numbers = pa.list_(pa.string()), pa.list_(pa.float64())
    schema = pa.schema([("seg", pa.int64()), ("ids", pa.binary()), ("labels", text), ("label_at", pa.list_(pa.int32())),
                        ("columns", pa.list_(pa.binary())), ("least", numbers), ("most", numbers), ("anchors", pa.binary())])
    return cut_lineage(_valid(rows, anchor).mapInArrow(pack, SEGMENT))


class Segment:
    """One row of ``segments`` as arrays."""

    def __init__(self, row: dict):
        self.seg, self.labels = row["seg"], row["labels"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.label_at = np.asarray(row["label_at"])
        self.columns = np.array([np.frombuffer(c) for c in row["columns"]]).reshape(-1, len(self.ids))
        self.least, self.most = np.asarray(row["least"], float), np.asarray(row["most"], float)
        self.anchors = np.frombuffer(row["anchors"], bool)
        self.largest = max(np.abs(self.least).max(initial=0), np.abs(self.most).max(initial=0))

    def rows_of(self, label: str) -> tuple[int, int]:
        """Where the rows of a label begin and end."""
        found = np.searchsorted(self.labels, label)
        if found == len(self.labels) or self.labels[found] != label:
            return 0, 0
        return int(self.label_at[found]), int(self.label_at[found + 1])


def _segments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Segment]:
    for batch in batches:
        for at in range(len(batch)):  # one segment as Python values at a time
            yield Segment({n: c[0].as_py() for n, c in zip(batch.schema.names, batch.slice(at, 1).columns)})


class Scan:
    """One anchor's way through a segment: candidates, their partial scores and the bounds of the rest."""

    def __init__(self, segment: Segment, vector: np.ndarray, start: int, end: int):
        dims = min(len(vector), len(segment.columns))
        query = vector[:dims]
        if len(query) * np.abs(query).max(initial=0) * segment.largest < EXACT:
            self.columns, least, most = segment.columns, segment.least, segment.most
        else:  # integers of any size
            whole = np.frompyfunc(int, 1, 1)
            query, self.columns = whole(query), whole(segment.columns)
            least, most = whole(segment.least), whole(segment.most)
        self.order = np.argsort(-np.abs(vector[:dims]), kind="stable")
        self.query = query[self.order]
        low, high = self.query * least[:dims][self.order], self.query * most[:dims][self.order]
        zero = np.zeros(1, self.query.dtype)
        # what the columns from the k-th on add at least and at most
        self.rest_least = np.concatenate([np.cumsum(np.minimum(low, high)[::-1])[::-1], zero])
        self.rest_most = np.concatenate([np.cumsum(np.maximum(low, high)[::-1])[::-1], zero])
        self.alive = np.arange(start, end)
        self.whole = slice(start, end)
        self.score = np.zeros(end - start, self.query.dtype)

    def steps(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Least and largest scores after every few columns; ``keep`` may be called in between."""
        for k in range(0, len(self.order), COLUMNS_AT_ONCE):
            upto = min(k + COLUMNS_AT_ONCE, len(self.order))
            read = self.columns[self.order[k:upto], self.whole] if self.whole else self.columns[np.ix_(self.order[k:upto], self.alive)]
            self.score = self.score + self.query[k:upto] @ read
            yield self.score + self.rest_least[upto], self.score + self.rest_most[upto]

    def keep(self, bitmap: np.ndarray) -> bool:
        """Leaves the candidates of the bitmap; False if none is left."""
        if not bitmap.all():
            self.alive, self.score, self.whole = self.alive[bitmap], self.score[bitmap], None
        return len(self.alive) > 0

    def drop(self, row: int) -> None:
        self.keep(self.alive != row)


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
    """The k highest scores with their ids; ties go to the smaller id."""
    if len(ids) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = scores > bar
        ties = np.sort(ids[scores == bar])[: k - above.sum()]
        ids, scores = np.concatenate([ids[above], ties]), np.concatenate([scores[above], np.full(len(ties), bar, scores.dtype)])
    return sorted(((int(s), int(i)) for s, i in zip(scores, ids)), key=lambda x: (-x[0], x[1]))


def _merged(held: list[tuple], more: list[tuple], k: int) -> list[tuple]:
    return sorted([*held, *more], key=lambda x: (-x[0], x[1]))[:k]


def nearest(segment: Segment, anchor: tuple, held: list[tuple], k: int) -> list[tuple]:
    """The first k of ``held`` and the segment's other rows of the anchor's label."""
    _, seg, row, label, vector = anchor
    start, end = segment.rows_of(label)
    if start == end:
        return held
    scan = Scan(segment, vector, start, end)
    if seg == segment.seg:
        scan.drop(row)
    bar = held[-1][0] if len(held) == k else None
    for low, high in scan.steps():
        if len(low) >= k:
            sure = np.partition(low, len(low) - k)[len(low) - k]
            bar = sure if bar is None else max(bar, sure)
        if bar is not None and not scan.keep(high >= bar):
            return held
    return _merged(held, _first(segment.ids[scan.alive], scan.score, k), k)


def in_windows(segment: Segment, anchor: tuple, windows: list[tuple], held: list[list[tuple]], k: int) -> list[list[tuple]]:
    """For each window of scores the first k of ``held`` and the segment's rows of other labels in it."""
    _, _, _, label, vector = anchor
    start, end = segment.rows_of(label)
    for begin, upto in ((0, start), (end, len(segment.ids))):
        if begin == upto:
            continue
        scan = Scan(segment, vector, begin, upto)
        bars = [max(low, h[-1][0]) if len(h) == k else low for (low, _), h in zip(windows, held)]
        least, most = min(bars), max(high for _, high in windows)
        if all(scan.keep((high >= least) & (low <= most)) for low, high in scan.steps()):
            for j, (low, high) in enumerate(windows):
                inside = (scan.score >= max(low, bars[j])) & (scan.score <= high)
                held[j] = _merged(held[j], _first(segment.ids[scan.alive[inside]], scan.score[inside], k), k)
    return held


def window_of(score: int) -> tuple[int, int]:
    """Least and largest score of a negative: LEAST * score <= 100 * it <= MOST * score."""
    return -(-LEAST * score // 100), MOST * score // 100


def _anchor_rows(packed: DataFrame) -> DataFrame:
    """``(seg, row, vec_id, label, vector)`` of the anchors, written with their number as ``position``."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment in _segments_of(batches):
            rows = np.flatnonzero(segment.anchors)
            label = np.repeat(np.arange(len(segment.labels)), np.diff(segment.label_at))
            yield pa.RecordBatch.from_pydict({
                "seg": pa.array(np.full(len(rows), segment.seg)), "row": pa.array(rows.astype(np.int32)),
                "vec_id": pa.array(segment.ids[rows]), "label": pa.array([segment.labels[x] for x in label[rows]], pa.string()),
                "vector": pa.array([c.tobytes() for c in segment.columns[:, rows].T], pa.binary()),
            })

    from colsieve.llm.positions import numbered

    found = packed.mapInArrow(unpack, "seg long, row int, vec_id long, label string, vector binary")
    return cut_lineage(numbered(found.withColumn("all", F.lit(0)), ["all"], [F.col("seg"), F.col("row")]).drop("all", "n"))


def _scanned(packed: DataFrame, kernel, schema: str) -> DataFrame:
    """Each task's ``kernel(segments)`` as rows ``(number, score, vec_id, more)``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = kernel(_segments_of(batches))
        top = 2**63 - 1
        columns = list(zip(*rows)) or [()] * 4
        names = ("number", "slot", "score", "vec_id")
        yield pa.RecordBatch.from_pydict({
            n: pa.array([min(max(v, -top), top) for v in c], pa.int64()) for n, c in zip(names, columns)})

    return packed.mapInArrow(scan, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


ROWS = "number long, slot long, score long, vec_id long"


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of all anchors.

    ``rows`` has vec_id, embedding and label; ``anchor`` says which of them are anchors. A score is
    the inner product of the components' ``floor(256 * x)``; higher ones come first, ties by smaller
    id. An anchor's positives are its first other rows of its label; for each of them the first rows
    of other labels in its window are returned, ranked from 1. Scores must fit 64 bits to be shown.

    Repeated rows are rows of their own, so a repeated anchor repeats its results. A null id comes
    after all others. A vector shorter than another counts as filled with zeros. Anchors without
    positives, and positives without negatives, give no row; nor does an empty table. Other columns
    are ignored.
    """
    packed = segments(rows, anchor)
    anchors = _anchor_rows(packed)
    sizes = anchors.agg(F.count("*"), F.max(F.length("vector"))).first()
    at_once = max(1, ANCHOR_BYTES // max(8, sizes[1] or 0))
    out = None
    for first in range(0, max(sizes[0], 1), at_once):
        part = _round(packed, anchors.filter(F.col("position").between(first, first + at_once - 1)), positives, negatives)
        out = part if out is None else out.unionByName(part)
    return out


def _round(packed: DataFrame, anchors: DataFrame, positives: int, negatives: int) -> DataFrame:
    """Results of at most ``ANCHOR_BYTES`` of anchors."""
    spark = packed.sparkSession
    sent = spark.sparkContext.broadcast([
        (r["position"], r["seg"], r["row"], r["label"], np.frombuffer(r["vector"])) for r in anchors.collect()])

    def positive_rows(scanned: Iterator[Segment]) -> list[tuple]:
        held = {a[0]: [] for a in sent.value}
        for segment in scanned:
            for a in sent.value:
                held[a[0]] = nearest(segment, a, held[a[0]], positives)
        return [(n, 0, score, vec) for n, found in held.items() for score, vec in found]

    chosen = cut_lineage(_best(_scanned(packed, positive_rows, ROWS), positives))
    windows: dict[int, list] = {}
    for r in chosen.select("number", "rank", "score").collect():  # a few for each anchor of the round
        windows.setdefault(r["number"], []).append((r["rank"], *window_of(r["score"])))
    asked = spark.sparkContext.broadcast({
        n: [w for w in found if w[1] <= w[2]] for n, found in windows.items() if any(w[1] <= w[2] for w in found)})

    def negative_rows(scanned: Iterator[Segment]) -> list[tuple]:
        wanted = asked.value
        held = {n: [[] for _ in found] for n, found in wanted.items()}
        for segment in scanned:
            for a in sent.value:
                if a[0] in wanted:
                    in_windows(segment, a, [w[1:] for w in wanted[a[0]]], held[a[0]], negatives)
        return [(n, w[0], score, vec) for n, found in held.items() for w, rows in zip(wanted[n], found) for score, vec in rows]

    found = cut_lineage(_best(_scanned(packed, negative_rows, ROWS), negatives))
    pairs = chosen.select("number", F.col("rank").cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    def named(c: str) -> Column:
        return F.when(F.col(c) != int(NO_ID), F.col(c))

    return found.join(pairs, ["number", "slot"]).join(
        anchors.select(F.col("position").alias("number"), F.col("vec_id").alias("anchor_id")), "number"
    ).select(
        named("anchor_id").alias("anchor_id"), named("positive_id").alias("positive_id"), "rank",
        named("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
