"""Benchmark decontamination by a BM25 index of the test items with block-max WAND.

Every passage of every document is a query. Term weights are BM25 divided by the item's own full
score, so one threshold holds for all items. First, for all passages at once, the terms without
which an item can't reach the threshold are looked up; a passage whose sum of them stays too low is
dropped, as MaxScore would. The rest run block-max WAND, which returns every item above the
threshold. A retrieved item is confirmed on its five-word shingles: those that end in the answer
(after the last question mark, else the last quarter) and the others are held against the document.

Items are indexed in shards of bounded size, each broadcast for one pass over the documents.
"""

from __future__ import annotations

import math
from array import array
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.llm import textscan
from colsieve.llm.store import small_batches

K1, B = 1.2, 0.75
THRESHOLD = 0.4  # of an item's own score
ESSENTIAL = 0.8  # share of an item's score in the terms that are looked up first
SHARE = 0.75  # of an item's shingles that the document must hold
LEAST = 0.5  # of the question's and of the answer's
WIDTH = 5
PASSAGE = 64  # words; longer where an item is longer
POSTINGS = 8  # items of a block
SHARD_ITEMS, SHARD_BYTES = 20_000, 16 << 20


def _answer_at(text: str, words: int) -> int:
    """The first word of the answer."""
    mark = max(text.rfind("?"), text.rfind("？"))
    after = len(text[mark + 1:].encode().split()) if mark >= 0 else 0
    return words - after if after else words - max(1, words // 4)


class Index:
    """Postings of one shard. Items of fewer than five words can't be confirmed and aren't indexed."""

    def __init__(self, items: list[tuple[int, str]]):
        part = next(textscan.slices(pa.array([t for _, t in items], pa.string()), limit=1 << 62, most=1 << 40), None)
        hashes = part.hashes() if part else np.zeros(0, np.uint64)
        bounds = part.doc_words if part else np.zeros(1, np.int64)
        self.ids: list[int] = []
        self.question: list[np.ndarray] = []
        self.answer: list[np.ndarray] = []
        words = []
        for k, (item, text) in enumerate(items):
            own = hashes[bounds[k]: bounds[k + 1]]
            if len(own) < WIDTH:
                continue
            at = np.arange(len(own) - WIDTH + 1)
            grams, last = textscan.segment_hash(own, at, at + WIDTH), at + WIDTH - 1
            answer = np.unique(grams[last >= _answer_at(text, len(own))])
            self.ids.append(item)
            self.answer.append(answer)
            self.question.append(np.setdiff1d(grams, answer))
            words.append(own)
        self.stride = max([PASSAGE, *map(len, words)])
        self._weigh(words)

    def _weigh(self, words: list[np.ndarray]) -> None:
        mean = np.mean([len(w) for w in words]) if words else 1.0
        lists: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for item, own in enumerate(words):
            for term, tf in zip(*(x.tolist() for x in np.unique(own, return_counts=True)), strict=True):
                lists[term].append((item, tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / mean))))
        self.terms = np.array(sorted(lists), np.uint64)
        self.items = [np.array([i for i, _ in lists[t]]) for t in self.terms.tolist()]
        self.impacts = []
        full = np.zeros(len(words))
        for t, at in zip(self.terms.tolist(), self.items, strict=True):
            idf = math.log(1 + (len(words) - len(at) + 0.5) / (len(at) + 0.5))
            self.impacts.append(idf * np.array([w for _, w in lists[t]]))
            full[at] += self.impacts[-1]
        self.impacts = [w / full[at] for w, at in zip(self.impacts, self.items, strict=True)]
        self.most = np.array([w.max() for w in self.impacts])
        self.block_most = [np.maximum.reduceat(w, np.arange(0, len(w), POSTINGS)) for w in self.impacts]
        # the same lists in a form whose single places are read fast, for retrieve
        self.places = [array("q", at.tolist()) for at in self.items]
        self.weights = [array("d", w.tolist()) for w in self.impacts]
        self.tops, self.block_tops = self.most.tolist(), [array("d", w.tolist()) for w in self.block_most]
        # essential terms: of each item the rarest, until the others can't reach 1 - ESSENTIAL
        own_terms: dict[int, list[tuple[float, int]]] = defaultdict(list)
        for t, (at, weight) in enumerate(zip(self.items, self.impacts, strict=True)):
            for i, w in zip(at.tolist(), weight.tolist(), strict=True):
                own_terms[i].append((w, t))
        self.rest = np.zeros(len(words))
        pairs = []
        for i, found in own_terms.items():
            covered = 0.0
            for w, t in sorted(found, reverse=True):
                if covered >= ESSENTIAL:
                    self.rest[i] += w
                else:
                    covered += w
                    pairs.append((t, i, w))
        pairs.sort()
        self.essential_terms = np.array([p[0] for p in pairs], np.int64)
        self.essential_items = np.array([p[1] for p in pairs], np.int64)
        self.essential_weights = np.array([p[2] for p in pairs])
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.terms >> np.uint64(48)).astype(np.int64)] = True

    def term_of(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of every word, -1 where the index lacks it."""
        out = np.full(len(hashes), -1, np.int64)
        near = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.terms, hashes[near]), max(len(self.terms) - 1, 0))
        hit = self.terms[spot] == hashes[near] if len(self.terms) else np.zeros(0, bool)
        out[near[hit]] = spot[hit]
        return out

    def retrieve(self, terms: list[int], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Every item whose score for these terms reaches the threshold, by block-max WAND."""
        found, limit, end = [], threshold - 1e-9, len(self.ids)
        places, tops, block_tops = self.places, self.tops, self.block_tops
        at = dict.fromkeys(terms, 0)
        here = {t: places[t][0] for t in terms}

        def skip_to(t: int, item: int) -> None:
            at[t] = bisect_left(places[t], item, at[t])
            if at[t] < len(places[t]):
                here[t] = places[t][at[t]]
            else:
                del at[t], here[t]

        while here:
            order = sorted(here, key=here.get)
            bound, pivot = 0.0, end
            for t in order:
                bound += tops[t]
                if bound >= limit:
                    pivot = here[t]
                    break
            if pivot == end:
                break
            ahead = [t for t in order if here[t] <= pivot]
            blocks = {t: bisect_left(places[t], pivot, at[t]) // POSTINGS for t in ahead}
            ceiling = sum(block_tops[t][b] for t, b in blocks.items() if b < len(block_tops[t]))
            if ceiling < limit:
                last = [places[t][min((b + 1) * POSTINGS, len(places[t])) - 1] + 1 for t, b in blocks.items()]
                after = [here[t] for t in order if here[t] > pivot]
                following = max(min([x for x in last if x > pivot] + after[:1], default=pivot + 1), pivot + 1)
                for t in ahead:
                    skip_to(t, following)
                continue
            score = 0.0
            for t in ahead:
                if here[t] < pivot:
                    skip_to(t, pivot)
                if here.get(t) == pivot:
                    score += self.weights[t][at[t]]
            if score >= limit:
                found.append((pivot, score))
            for t in ahead:
                if here.get(t) == pivot:
                    skip_to(t, pivot + 1)
        return found

    def leaks(self, part: textscan.Slice) -> list[list[tuple[int, float, float]]]:
        """Confirmed ``(item_id, question overlap, answer overlap)`` of every document of a slice."""
        out: list[list] = [[] for _ in range(part.count)]
        hashes = part.hashes()
        terms = self.term_of(hashes)
        hits = np.flatnonzero(terms >= 0)
        if not len(hits):
            return out
        owner = np.searchsorted(part.doc_words, hits, side="right") - 1
        step = (hits - part.doc_words[owner]) // self.stride
        counts = np.diff(part.doc_words) // self.stride + 1
        base = np.concatenate(([0], np.cumsum(counts)))
        # a passage is two strides long, so every word but those of the first stride lies in two
        passage = np.concatenate((base[owner] + step, (base[owner] + step - 1)[step > 0]))
        term = np.concatenate((terms[hits], terms[hits][step > 0]))
        keys = np.unique(passage * len(self.terms) + term)
        passage, term = keys // len(self.terms), keys % len(self.terms)
        low = np.searchsorted(self.essential_terms, term)
        size = np.searchsorted(self.essential_terms, term, side="right") - low
        spot = np.arange(size.sum()) + np.repeat(low - np.concatenate(([0], np.cumsum(size)))[:-1], size)
        pairs, back = np.unique(
            np.repeat(passage, size) * len(self.ids) + self.essential_items[spot], return_inverse=True)
        sums = np.bincount(back, self.essential_weights[spot], len(pairs))
        able = np.unique(pairs[sums + self.rest[pairs % len(self.ids)] >= THRESHOLD - 1e-9] // len(self.ids))
        retrieved = defaultdict(set)
        for p in able.tolist():
            a, b = np.searchsorted(passage, [p, p + 1])
            doc = int(np.searchsorted(base, p, side="right")) - 1
            retrieved[doc].update(i for i, _ in self.retrieve(term[a:b].tolist()))
        for doc, found in retrieved.items():
            first, last = part.doc_words[doc], part.doc_words[doc + 1]
            at = np.arange(first, max(last - WIDTH + 1, first))
            grams = np.unique(textscan.segment_hash(hashes, at, at + WIDTH))
            for i in sorted(found):
                q, a = (int(np.isin(x[i], grams).sum()) for x in (self.question, self.answer))
                nq, na = len(self.question[i]), len(self.answer[i])
                if q + a >= SHARE * (nq + na) and q >= LEAST * nq and a >= LEAST * na:
                    out[doc].append((self.ids[i], q / nq if nq else 1.0, a / na if na else 1.0))
        return out


_FOUND = "array<struct<item_id: bigint, question_overlap: double, answer_overlap: double>>"
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())]))


def found_items(index: Index, text: Column) -> Column:
    """Array of the items that a text holds."""

    def search(texts: pa.Array) -> pa.Array:
        rows: list = []
        for part in textscan.slices(texts):
            rows += index.leaks(part)
        names = ("item_id", "question_overlap", "answer_overlap")
        return pa.array([[dict(zip(names, x, strict=True)) for x in row] for row in rows], _ARROW)

    return F.arrow_udf(search, _FOUND)(F.coalesce(text.cast("string"), F.lit("")))


def shards(items: DataFrame) -> list[Index]:
    """Indexes over all items, each of bounded size."""
    small_batches(items.sparkSession)
    clean = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    count, size = clean.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    number = max(1, -(-count // SHARD_ITEMS), -(-size // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("item_id"), F.lit(number))
    return [
        Index(sorted((r.item_id, r.text) for r in clean.filter(shard == k).toLocalIterator())) for k in range(number)
    ]


def leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, question_overlap, answer_overlap)`` of every document row and item it holds.

    Null or empty texts and items, items without id and items of fewer than five words match nothing.
    Repeated items count once, repeated documents each. Other columns are ignored.
    """
    texts, out = docs.select("doc_id", "text"), None
    for index in shards(items):
        rows = texts.select("doc_id", F.explode(found_items(index, F.col("text"))).alias("x")).select("doc_id", "x.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    for index in shards(items):
        docs = docs.filter(F.size(found_items(index, F.col("text"))) == 0)
    return docs
