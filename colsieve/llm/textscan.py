"""Words, lines and their hashes, found in a whole Arrow batch at once.

A word is a run of bytes outside space and U+0009 to U+000D; in UTF-8 no other character holds
such a byte, so the scan works on bytes. Text is cut at document ends into slices of about
``SLICE_BYTES``, so the arrays stay small; a longer document is one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, kept per process and not shipped."""

    def __init__(self):
        self.forward = self.backward = np.zeros(0, np.uint64)

    def __reduce__(self):
        return type(self), ()

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.forward) < count:
            size = 1 << max(20, count.bit_length())
            forward = np.full(size, _BASE, np.uint64)
            backward = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
            forward[0] = backward[0] = 1
            self.forward, self.backward = np.multiply.accumulate(forward), np.multiply.accumulate(backward)
        return self.forward, self.backward


_powers = _Powers()


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = values ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def segment_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the sequence ``values[start:end]`` for every pair of bounds."""
    forward, backward = _powers.upto(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forward[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * backward[starts])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _VALUES[data]


def lower_values(data: np.ndarray) -> np.ndarray:
    return _VALUES[_LOWER[data]]


@dataclass
class Slice:
    """Documents ``first`` up to ``first + len(doc_bytes) - 1`` of a batch."""

    first: int
    data: np.ndarray  # bytes of all documents of the slice
    doc_bytes: np.ndarray  # bounds of documents in bytes
    starts: np.ndarray  # of words, in bytes
    ends: np.ndarray
    doc_words: np.ndarray  # bounds of documents in words

    @property
    def count(self) -> int:
        return len(self.doc_bytes) - 1

    def hashes(self, lower: bool = True) -> np.ndarray:
        return segment_hash(_VALUES[_LOWER[self.data] if lower else self.data], self.starts, self.ends)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.count), np.diff(self.doc_words))


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document bounds of a text column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]: bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES, most: int = 8192) -> Iterator[Slice]:
    """Slices of at most ``limit`` bytes, or one longer document, and ``most`` documents."""
    data, bounds = raw_bytes(column)
    first, count = 0, len(bounds) - 1
    while first < count:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), first + most, count)
        yield scan(data[bounds[first]: bounds[last]], bounds[first: last + 1] - bounds[first], first)
        first = last


def scan(data: np.ndarray, bounds: np.ndarray, first: int = 0) -> Slice:
    solid = ~_SPACE[data]
    inner = bounds[:-1][np.diff(bounds) > 0]  # ends of words at document ends are the next starts
    before = np.empty_like(solid)
    before[1:], before[:1] = solid[:-1], False
    before[inner] = False
    after = np.empty_like(solid)
    after[:-1], after[-1:] = solid[1:], False
    after[inner[1:] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    return Slice(first, data, bounds, starts, ends, np.searchsorted(starts, bounds))


def windows(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends, in words, of all runs of ``width`` words, and run bounds per document.

    A document of fewer words has its whole sequence as its one run; one without words has none.
    """
    words = np.diff(part.doc_words)
    runs = np.where(words >= width, words - width + 1, np.minimum(words, 1))
    bounds = np.concatenate(([0], np.cumsum(runs)))
    starts = np.arange(bounds[-1]) + np.repeat(part.doc_words[:-1] - bounds[:-1], runs)
    return starts, starts + np.repeat(np.minimum(words, width), runs), bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every segment, and the new bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[fresh], owner[fresh]
    return values, np.searchsorted(owner, np.arange(len(bounds)))


def int64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def large_list(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)


def binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary per segment of an array of fixed-width values."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values)),
    ])
