"""Quality rules with cross-document line frequency.

Within a text: word, symbol, repeated-line and repeated-window counts. Across texts: every line is
hashed in normal form (lower-case words, white space of no account), the documents of each host that
hold it are counted, lines in more than ``MAX_DOCUMENTS`` of them are removed, and documents that
lose more than ``MAX_LOST`` of their words are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsieve.llm import textscan
from colsieve.llm.store import cut_lineage, small_batches

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 20  # percent of words
MAX_DOCUMENTS = 20  # of one host that may share a line
MAX_LOST = 0.7  # share of words
PIECE_LINES = 1 << 22  # common lines that go to the tasks in one pass, 8 bytes each
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

_FIELDS = (
    "doc_id long, place long, text string, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, n_removed_words long"
)
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated(part: textscan.Slice, hashes: np.ndarray) -> np.ndarray:
    """Per document, words inside a window that the document holds twice or more."""
    words = np.diff(part.doc_words)
    runs = np.maximum(words - WINDOW + 1, 0)
    bounds = np.concatenate(([0], np.cumsum(runs)))
    owner = np.repeat(np.arange(part.count), runs)
    starts = np.arange(bounds[-1]) + np.repeat(part.doc_words[:-1] - bounds[:-1], runs)
    grams = textscan.segment_hash(hashes, starts, starts + WINDOW)
    order = np.lexsort((grams, owner))
    same = (grams[order][1:] == grams[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, starts[twice], 1)
    np.add.at(edges, starts[twice] + WINDOW, -1)
    return _sums(np.cumsum(edges)[:-1] > 0, part.doc_words)


def _lines(part: textscan.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte bounds of lines with words, their document, bounds in words, and number in the document."""
    breaks = np.flatnonzero(part.data == 10)
    starts = np.concatenate((part.doc_bytes[:-1], breaks + 1))
    ends = np.concatenate((part.doc_bytes[1:], breaks))
    owner = np.concatenate((np.arange(part.count), np.searchsorted(part.doc_bytes, breaks, side="right") - 1))
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    ends = np.append(starts[1:] - 1, 0)
    last = np.ones(len(starts), bool)
    last[:-1] = owner[1:] != owner[:-1]
    ends[last] = part.doc_bytes[1:][owner[last]]
    first_word = np.searchsorted(part.starts, starts)
    last_word = np.searchsorted(part.starts, ends)
    full = last_word > first_word
    number = np.arange(len(owner)) - np.searchsorted(owner, owner)
    return starts[full], ends[full], owner[full], np.stack((first_word[full], last_word[full])), number[full]


def _keys(part: textscan.Slice, places: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hash of every line in normal form and of its host."""
    normal = textscan.segment_hash(part.hashes(), bounds[0], bounds[1])
    return textscan.mix(normal ^ textscan.mix(places.view(np.uint64), 1)[owner])


def _again(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks values that an earlier place of the same owner has."""
    order = np.lexsort((np.arange(len(values)), values, owner))
    same = (values[order][1:] == values[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    marks = np.zeros(len(values), bool)
    marks[order[1:][same]] = True
    return marks


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[textscan.Slice, pa.RecordBatch, np.ndarray]]:
    """Slices of the texts with their rows and hosts."""
    text, place = (batch.schema.get_field_index(c) for c in ("text", "place"))
    for part in textscan.slices(batch.column(text)):
        own = batch.slice(part.first, part.count)
        yield part, own, own.column(place).to_numpy()


def _held_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, _, places in _slices(batch):
            _, _, owner, bounds, _ = _lines(part)
            steps = np.searchsorted(owner, np.arange(part.count + 1))
            held, _ = textscan.distinct(_keys(part, places, owner, bounds), steps)
            yield pa.RecordBatch.from_arrays([textscan.int64(held)], names=["line"])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, own, _ in _slices(batch):
            exact = part.hashes(lower=False)
            shown = np.concatenate(([0], np.cumsum((part.data & 0xC0) != 0x80)))
            starts, ends, owner, _, _ = _lines(part)
            raw = textscan.segment_hash(textscan.byte_values(part.data), starts, ends)
            repeats = _sums(_again(raw, owner), np.searchsorted(owner, np.arange(part.count + 1)))
            yield pa.RecordBatch.from_arrays([
                *own.columns,
                pa.array(np.diff(part.doc_words).astype(np.int64)),
                pa.array(_sums(shown[part.ends] - shown[part.starts], part.doc_words)),
                pa.array(_sums(_SYMBOLS[part.data], part.doc_bytes)),
                pa.array(repeats),
                pa.array(_repeated(part, exact)),
                pa.array(np.zeros(part.count, np.int64)),
            ], names=_NAMES)


def _without(common: np.ndarray, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows with those lines taken out of their texts and the words lost added up."""
    for part, own, places in _slices(batch):
        _, _, owner, bounds, number = _lines(part)
        keys = _keys(part, places, owner, bounds)
        gone = common[np.minimum(np.searchsorted(common, keys), len(common) - 1)] == keys
        owner, number, sizes = owner[gone], number[gone], (bounds[1] - bounds[0])[gone]
        texts = own.column(2).to_pylist()
        steps = np.searchsorted(owner, np.arange(part.count + 1))
        for doc in np.flatnonzero(np.diff(steps)).tolist():
            lines = texts[doc].split("\n")
            for at in number[steps[doc]: steps[doc + 1]].tolist():
                lines[at] = None
            texts[doc] = "\n".join(x for x in lines if x is not None)
        lost = own.column(8).to_numpy() + _sums(sizes, steps)
        yield pa.RecordBatch.from_arrays(
            [*own.columns[:2], pa.array(texts, pa.string()), *own.columns[3:8], pa.array(lost)], names=_NAMES)


def clean(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_lost: float = MAX_LOST) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: text without common lines, counts and verdict.

    Lines that more than ``max_documents`` rows of the same source hold are common; null sources are one
    host. ``n_removed_words`` counts the words that went with them, the other counts are of the whole
    text. Null and empty texts fail by length; repeated rows count as documents of their own. Other
    columns are ignored.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("source").cast("string")).alias("place"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    common = cut_lineage(rows.mapInArrow(_held_lines, "line long").groupBy("line").agg(
        F.count("*").alias("documents")).filter(F.col("documents") > max_documents).select("line"))
    pieces = -(-common.count() // PIECE_LINES)
    cleaned = rows.mapInArrow(_measure, _FIELDS)
    for k in range(pieces):
        # at most about PIECE_LINES hashes
        lines = common.filter(F.pmod(F.xxhash64("line"), F.lit(pieces)) == k).toArrow().column(0).to_numpy()
        sent = docs.sparkSession.sparkContext.broadcast(np.sort(lines.view(np.uint64)))

        def remove(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _without(sent.value, batch)

        cleaned = (cut_lineage(cleaned) if k else cleaned).mapInArrow(remove, _FIELDS)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return cleaned.drop("place").withColumns({
        "base_failed": failed, "kept": ~failed & (F.col("n_removed_words") <= max_lost * F.col("n_words"))})


def quality_rules(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, max_lost: float = MAX_LOST) -> DataFrame:
    """The counts and the verdict of ``clean``, without the text."""
    return clean(docs, max_documents, max_lost).drop("text")


def without_common_lines(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``(doc_id, text)`` with the common lines taken out; other columns are ignored."""
    return clean(docs, max_documents).select("doc_id", "text")
