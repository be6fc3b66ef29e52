"""Order statistics by narrowing intervals of the values' bit patterns; values themselves never move.

The pattern of a double, with its sign turned, sorts like the double. A step cuts every interval that
holds a wanted rank into equal parts; tasks count their rows in each part and note the least and
greatest pattern seen there. Added up, the counts tell which parts hold wanted ranks; these are the
next intervals, as narrow as their own values. A part with one value answers its ranks. What a task
sends in a step is bounded by ``CELLS``, whatever the number of rows. Spark adds up equal parts of all
tasks, so what a Python worker holds depends neither on the rows nor on the number of tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsieve.operators.gram import TASKS_PER_CORE, matrix

CELLS = 1 << 18  # parts that one task counts in a step, over all columns
CHUNK_BITS = 14  # parts looked through at a time, or those of one interval
MOST_BITS = 16  # an interval is cut into 2**16 parts at most
HELD_VALUES = 1 << 20  # values put in order at a time
TOP = np.uint64(1 << 63)
REST = np.int64((1 << 63) - 1)


def pattern(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; -0.0 is 0.0."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ REST, bits).view(np.uint64) ^ TOP


def value(patterns: np.ndarray) -> np.ndarray:
    bits = (patterns ^ TOP).view(np.int64)
    return np.where(bits < 0, bits ^ REST, bits).view(np.float64)


class Intervals:
    """Disjoint ranges of patterns of one column, in order, with the rank of the first row in each."""

    def __init__(self, low: np.ndarray, high: np.ndarray, first: np.ndarray, cells: int):
        self.low, self.high, self.first = low, high, first
        self.bits = max(1, min(MOST_BITS, int(math.log2(max(2, cells // max(1, len(low)))))))
        widths = [int(w).bit_length() for w in high - low]
        self.shift = np.array([max(0, w - self.bits) for w in widths], np.uint64)

    def parts(self, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the ordered patterns that lie in an interval, and the part of each."""
        at = np.searchsorted(self.low, ordered, "right") - 1
        inside = (at >= 0) & (ordered <= self.high[at])
        ordered, at = ordered[inside], at[inside]
        return ordered, (at << self.bits) | ((ordered - self.low[at]) >> self.shift[at]).astype(np.int64)


def _counted(code: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal codes added up; codes are in order."""
    if not len(code):
        return code, n, low, high
    begin = np.concatenate([[0], np.flatnonzero(np.diff(code)) + 1])
    return code[begin], np.add.reduceat(n, begin), np.minimum.reduceat(low, begin), np.maximum.reduceat(high, begin)


def _signed(patterns: np.ndarray) -> np.ndarray:
    """The same order in Spark's signed numbers."""
    return (patterns ^ TOP).view(np.int64)


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    joined = [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(joined[0], kind="stable")
    return _counted(*[c[order] for c in joined])


PARTIAL = "pos int, chunk long, code long, n long, low long, high long"
FOUND = "pos int, low binary, high binary, first binary, n binary, valid long"
FIELDS = [f.split()[0] for f in PARTIAL.split(", ")]
WHOLE = (np.zeros(1, np.uint64), np.full(1, np.uint64(2**64 - 1)), np.zeros(1, np.int64))


def wanted_ranks(probs: np.ndarray, n: int) -> np.ndarray:
    """0-based ranks that the quantiles interpolate between."""
    place = probs * (n - 1)
    return np.unique(np.concatenate([np.floor(place), np.ceil(place)])).astype(np.int64)


def _step(df: DataFrame, open_intervals: dict[int, Intervals], valid: dict[int, int], probs: np.ndarray) -> list:
    """Parts of the intervals that hold wanted ranks, with their counts; few per rank."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((open_intervals, valid))
    names = df.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        intervals, _ = sent.value
        held: dict[int, list] = {p: [] for p in intervals}
        rows: list[np.ndarray] = []

        def put() -> None:
            block = np.concatenate(rows)
            for p, found in held.items():
                x = block[:, p]
                ordered, code = intervals[p].parts(np.sort(pattern(x[~np.isnan(x)])))
                found.append(_counted(code, np.ones(len(code), np.int64), ordered, ordered))
                if len(found) > 8:
                    found[:] = [_merged(found)]
            rows.clear()

        for batch in batches:
            rows.append(matrix(batch, names))
            if sum(map(len, rows)) * len(names) >= HELD_VALUES:
                put()
        if rows:
            put()
        for p, found in held.items():
            if found:
                code, n, low, high = _merged(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(code), p, np.int32)), pa.array(code >> max(intervals[p].bits, CHUNK_BITS)),
                    pa.array(code), pa.array(n), pa.array(_signed(low)), pa.array(_signed(high))], names=FIELDS)

    def narrow(key, table):
        intervals, known = sent.value
        p = key[0].as_py()
        code, n, low, high = (table.column(c).to_numpy() for c in ("code", "n", "low", "high"))
        order = np.argsort(code)
        code, n = code[order], n[order]
        low, high = (c[order].view(np.uint64) ^ TOP for c in (low, high))
        total = known.get(p, int(n.sum()))  # the first step has one interval, and so one chunk
        at = code >> intervals[p].bits
        begin = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        before = np.cumsum(n) - n
        first = intervals[p].first[at] + before - np.repeat(before[begin], np.diff(np.append(begin, len(at))))
        ranks = wanted_ranks(probs, total)
        keep = np.searchsorted(ranks, first) < np.searchsorted(ranks, first + n)
        return pa.table({"pos": pa.array([p], pa.int32()), **{c: [v[keep].tobytes()] for c, v in (("low", low), ("high", high), ("first", first), ("n", n))},
                         "valid": pa.array([total], pa.int64())})

    tasks = max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # One shuffle: equal parts are added up where their chunk is.
    dealt = df.coalesce(tasks).mapInArrow(count, PARTIAL).repartition("pos", "chunk")
    added = dealt.groupBy("pos", "chunk", "code").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    return added.groupBy("pos", "chunk").applyInArrow(narrow, FOUND).collect()


def order_statistics(df: DataFrame, probs: list[float]) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """By column position the number of values, the wanted ranks and the values at them.

    Columns are doubles; NULL and NaN don't count. A column without values is left out.
    """
    asked = np.asarray(probs, float)
    cells = max(2, CELLS // max(1, len(df.columns)))
    intervals = {p: Intervals(*WHOLE, cells) for p in range(len(df.columns))}
    valid: dict[int, int] = {}
    known: dict[int, list] = {}
    while intervals:
        found, intervals = _step(df, intervals, valid, asked), {}
        wider: dict[int, list] = {}
        for row in found:
            p, valid[row["pos"]] = row["pos"], row["valid"]
            low, high = np.frombuffer(row["low"], np.uint64), np.frombuffer(row["high"], np.uint64)
            first, n = np.frombuffer(row["first"], np.int64), np.frombuffer(row["n"], np.int64)
            one = low == high
            known.setdefault(p, []).append((first[one], n[one], low[one]))
            if not one.all():
                wider.setdefault(p, []).append((low[~one], high[~one], first[~one]))
        for p, parts in wider.items():
            low, high, first = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(low)  # chunks arrive in any order
            intervals[p] = Intervals(low[order], high[order], first[order], cells)
    out = {}
    for p, parts in known.items():
        first, _, low = (np.concatenate(c) for c in zip(*parts))
        if valid[p]:
            order = np.argsort(first)
            ranks = wanted_ranks(asked, valid[p])
            out[p] = valid[p], ranks, value(low[order])[np.searchsorted(first[order], ranks, "right") - 1]
    return out


def interpolated(probs: list[float], n: int, ranks: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Linear interpolation between order statistics, never above the upper one."""
    place = np.asarray(probs, float) * (n - 1)
    low = values[np.searchsorted(ranks, np.floor(place))]
    high = values[np.searchsorted(ranks, np.ceil(place))]
    with np.errstate(invalid="ignore"):
        between = np.where(low == high, low, low + (place - np.floor(place)) * (high - low))
    return np.minimum(between, high)


def quantile_rows(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """``(col, q)`` of some columns; q is null where there is no value."""
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    found = order_statistics(numbers, probs)
    rows = [interpolated(probs, *found[p]) if p in found else None for p in range(len(columns))]
    table = pa.table({"col": pa.array(columns, pa.string()), "q": pa.array(rows, pa.list_(pa.float64()))})
    return df.sparkSession.createDataFrame(table, "col string, q array<double>")
