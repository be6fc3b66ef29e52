"""Interpolated modified Kneser-Ney bigram model, counted in Spark, for log-probabilities of texts.

Documents are encoded once, in chunks of about a million tokens: sorted word keys and each token as
a number into them. A chunk sends its distinct bigrams, with their training counts, to shards by
context; the few contexts that hold a large share of all tokens are spread over all shards. A shard
adds the counts up, stores bigram hashes as a sorted array beside their counts, memory-maps both and
answers every chunk's bigrams from there. It also sends what a context's followers add up to, and in
how many contexts a word was seen, to word shards, which answer the chunks' words the same way. A
chunk then has all it needs to score its texts. Shards hold a bounded number of tokens' bigrams, so
their number grows with the input; what the driver sees is a few sums.

Words are known by 40 bits of their hash (``KEY_BYTES``).
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colsieve.llm import textscan
from colsieve.llm.store import cut_lineage, small_batches

CHUNK_TOKENS = 1 << 20
SHARD_TOKENS = 1 << 21
KEY_BYTES = 5
_KEY = np.uint64((1 << (8 * KEY_BYTES)) - 1)
END = np.uint64(0x0E4D5EED11)  # keys of the end of a text and of the place before it
START = np.uint64(0x57A47B0B17)
_NONE = np.zeros(0, np.uint64)


def _pack_keys(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def _keys(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :KEY_BYTES] = raw
    return out.view("<u8").ravel().astype(np.uint64)


def _pack(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Integers byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: str = "<u4") -> np.ndarray:
    width = int(kind[-1])
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64)


def _pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return textscan.mix(context * np.uint64(0x9E3779B97F4A7C15) + word)


_CHUNKS = (
    "chunk long, doc_id array<long>, held_out array<boolean>, sizes binary, words binary, tokens binary, "
    "counts binary, train_tokens long"
)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, docs, parts, sizes, held_tokens = TaskContext.get().partitionId() << 32, [], [], [], 0

    def chunk() -> pa.RecordBatch:
        ids, held = (pa.concat_arrays([d[k] for d in docs]) for k in (0, 1))
        length = np.concatenate(sizes)
        words, tokens, total = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        order = np.argsort(-total, kind="stable")  # frequent words get small numbers
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words, tokens = words[order], rank[tokens]
        train = np.repeat(~held.to_numpy(zero_copy_only=False), length)
        counts = np.bincount(tokens[train], minlength=len(words))
        row = [number, ids, held, _pack(length), _pack_keys(words), _pack(tokens), _pack(counts), int(train.sum())]
        return pa.RecordBatch.from_arrays([
            pa.array([row[0]]), *(pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in row[1:3]),
            *(pa.array([x], pa.binary()) for x in row[3:7]), pa.array([row[7]]),
        ], names=[f.split()[0] for f in _CHUNKS.split(", ")])

    for batch in batches:
        for part in textscan.slices(batch.column(2)):
            docs.append((batch.column(0).slice(part.first, part.count), batch.column(1).slice(part.first, part.count)))
            # each text's words, then its end
            length = np.diff(part.doc_words) + 1
            keys = np.full(int(length.sum()), END, np.uint64)
            inside = np.ones(len(keys), bool)
            inside[np.cumsum(length) - 1] = False
            keys[inside] = part.hashes() & _KEY
            parts.append(keys)
            sizes.append(length)
            held_tokens += len(keys)
            if held_tokens >= CHUNK_TOKENS:
                yield chunk()
                number, docs, parts, sizes, held_tokens = number + 1, [], [], [], 0
    if docs:
        yield chunk()


@dataclass
class Chunk:
    """A decoded chunk with its distinct bigrams."""

    words: np.ndarray
    tokens: np.ndarray
    bounds: np.ndarray
    train: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Chunk:
        sizes = _unpack(row["sizes"])
        held = np.array(row["held_out"], bool)
        return cls(np.append(_keys(row["words"]), START), _unpack(row["tokens"]),
                   np.concatenate(([0], np.cumsum(sizes))), np.repeat(~held, sizes))

    def bigrams(self) -> np.ndarray:
        """Context and word of every token, as one number."""
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.bounds[:-1]] = len(self.words) - 1
        return before * len(self.words) + self.tokens

    def dealt(self, pairs: np.ndarray, shards: int, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs in the order in which they are sent: pairs, contexts, words, shards."""
        context, word = self.words[pairs // len(self.words)], self.words[pairs % len(self.words)]
        shard = textscan.mix(context, 77) % np.uint64(shards)
        hot = np.isin(context, spread)
        shard[hot] = _pair_hash(context[hot], word[hot]) % np.uint64(shards)
        order = np.argsort(shard, kind="stable")
        return pairs[order], context[order], word[order], shard[order].astype(np.int64)


def _rows(schema: str, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        names = [f.split()[0] for f in schema.split(", ")]
        kinds = [pa.binary() if f.endswith("binary") else pa.string() if f.endswith("string") else pa.int64()
                 for f in schema.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


_BIGRAMS = "shard long, chunk long, contexts binary, runs binary, words binary, counts binary"


def _send_bigrams(shards: int, spread: np.ndarray):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk, out = Chunk.of(row), []
                each = chunk.bigrams()
                pairs, context, word, shard = chunk.dealt(np.unique(each), shards, spread)
                seen, times = np.unique(each[chunk.train], return_counts=True)
                spot = np.minimum(np.searchsorted(seen, pairs), max(len(seen) - 1, 0))
                counts = np.where(seen[spot] == pairs, times[spot], 0) if len(seen) else np.zeros(len(pairs), np.int64)
                bounds = np.searchsorted(shard, np.arange(shards + 1))
                for s in np.flatnonzero(np.diff(bounds)).tolist():
                    a, b = bounds[s], bounds[s + 1]
                    fresh = np.flatnonzero(np.append(True, context[a + 1: b] != context[a: b - 1]))
                    runs = np.diff(np.append(fresh, b - a))
                    out.append((s, row["chunk"], _pack_keys(context[a:b][fresh]), _pack(runs),
                                _pack_keys(word[a:b]), _pack(counts[a:b])))
                yield from _rows(_BIGRAMS, out)
    return send


def _mapped(values: np.ndarray) -> np.ndarray:
    """The values in a memory-mapped file that has no name and ends with the process."""
    with tempfile.TemporaryFile() as file:
        file.write(np.ascontiguousarray(values).data if len(values) else b"\0" * 8)
        file.flush()
        return np.memmap(file, values.dtype, "r", shape=(max(len(values), 1),))[: len(values)]


def _words_message(kind: int, keys: np.ndarray, columns: list[np.ndarray], shards: int) -> list[tuple]:
    """Rows (kind, shard, -1, keys, values) that carry sums of words to their shards."""
    shard = textscan.mix(keys, 99) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    out = []
    for s in np.flatnonzero(np.diff(bounds)).tolist():
        part = order[bounds[s]: bounds[s + 1]]
        out.append((f"w{kind}", s, -1, _pack_keys(keys[part]), _pack(np.concatenate([c[part] for c in columns]), "<u8")))
    return out


_PARTS = "kind string, shard long, chunk long, keys binary, data binary"


def _sums(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    unique, back = np.unique(keys, return_inverse=True)
    return unique, [np.bincount(back, c, len(unique)).astype(np.int64) for c in columns]


def _bigram_shard(word_shards: int):
    """Adds up one shard and answers the chunks that sent to it."""

    def reduce(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        contexts = [np.repeat(_keys(r["contexts"]), _unpack(r["runs"])) for r in rows]
        words = [_keys(r["words"]) for r in rows]
        counts = np.concatenate([_unpack(r["counts"]) for r in rows])
        context, word = np.concatenate(contexts), np.concatenate(words)
        taught = counts > 0
        hashes, first, back = np.unique(
            _pair_hash(context[taught], word[taught]), return_index=True, return_inverse=True)
        total = np.bincount(back, counts[taught], len(hashes)).astype(np.int64)
        context, word = context[taught][first], word[taught][first]
        stored, stored_total = _mapped(hashes), _mapped(total)
        out = []
        for row, c, w in zip(rows, contexts, words, strict=True):
            out.append(("bigram", row["shard"], row["chunk"], b"", _pack(_look(stored, stored_total, _pair_hash(c, w)))))
        out += _words_message(1, *_sums(word, np.ones(len(word), np.int64)), word_shards)
        levels = [total, *((total == k).astype(np.int64) for k in (1, 2)), (total > 2).astype(np.int64)]
        out += _words_message(2, *_sums(context, *levels), word_shards)
        out.append(("discount", -1, -1, b"", _pack(np.array([(total == k).sum() for k in (1, 2, 3, 4)]), "<u8")))
        return pa.Table.from_batches(list(_rows(_PARTS, out)))

    return reduce


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[spot] == wanted, values[spot], 0)


def _send_words(shards: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.append(_keys(row["words"]), START)
                out = _words_message(0, keys, [np.append(_unpack(row["counts"]), 0)], shards)
                yield from _rows(_PARTS, [(k, s, row["chunk"], a, b) for k, s, _, a, b in out])
    return send


def _word_shard(table: pa.Table) -> pa.Table:
    """Per word: training count, contexts seen, and as a context total, ones, twos and more."""
    rows = table.to_pylist()
    width, place = {"w0": 1, "w1": 1, "w2": 4}, {"w0": 0, "w1": 1, "w2": 2}
    keys = [_keys(r["keys"]) for r in rows]
    unique, back = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros((6, len(unique)), np.int64)
    at = 0
    for row, own in zip(rows, keys, strict=True):
        values = _unpack(row["data"], "<u8").reshape(width[row["kind"]], len(own))
        for k, column in enumerate(values):
            np.add.at(sums[place[row["kind"]] + k], back[at: at + len(own)], column)
        at += len(own)
    stored, columns, out = _mapped(unique), [_mapped(c) for c in sums], []
    for row, own in zip(rows, keys, strict=True):
        if row["kind"] == "w0":
            answer = np.concatenate([_look(stored, c, own) for c in columns])
            out.append(("word", row["shard"], row["chunk"], row["keys"], _pack(answer, "<u8")))
    seen, contexts = sums[0], sums[1]
    stats = [seen.sum(), (seen > 0).sum(), contexts.sum(), *((contexts == k).sum() for k in (1, 2, 3, 4)), (contexts > 2).sum()]
    out.append(("totals", -1, -1, b"", _pack(np.array(stats), "<u8")))
    return pa.Table.from_batches(list(_rows(_PARTS, out)))


def discounts(ones: float, twos: float, threes: float, fours: float) -> tuple[float, float, float]:
    """Of counts one, two and more; fixed ones where a count of counts is zero."""
    if min(ones, twos, threes, fours) <= 0:
        return 0.5, 1.0, 1.5
    y = ones / (ones + 2 * twos)
    found = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))


@dataclass
class Totals:
    """Sums over the whole training part."""

    tokens: int
    distinct: int
    bigrams: int
    pair: tuple[float, float, float]
    single: tuple[float, float, float]
    held_back: float  # share of the word distribution that goes to the uniform one

    def word_probability(self, contexts: np.ndarray) -> np.ndarray:
        uniform = 1.0 / (self.distinct + 1)
        if not self.bigrams:
            return np.full(len(contexts), uniform)
        return _discounted(contexts, self.single) / self.bigrams + self.held_back * uniform


def _discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *by])[np.minimum(counts, 3)], 0.0)


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score(shards: int, spread: np.ndarray, totals: Totals):
    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row, answers = left.to_pylist()[0], right.to_pylist()
        chunk = Chunk.of(row)
        each = chunk.bigrams()
        pairs, _, _, shard = chunk.dealt(np.unique(each), shards, spread)
        counts = np.zeros(len(pairs), np.int64)
        for a in answers:
            if a["kind"] == "bigram":
                counts[slice(*np.searchsorted(shard, [a["shard"], a["shard"] + 1]))] = _unpack(a["data"])
        order = np.argsort(pairs)
        counts = counts[order][np.searchsorted(pairs[order], each)]
        known = [(_keys(a["keys"]), _unpack(a["data"], "<u8").reshape(6, -1)) for a in answers if a["kind"] == "word"]
        keys, columns = np.concatenate([k for k, _ in known]), np.concatenate([v for _, v in known], axis=1)
        by_key = np.argsort(keys)
        columns = columns[:, by_key[np.searchsorted(keys[by_key], chunk.words)]]
        seen, contexts, total, ones, twos, more = columns
        single = totals.word_probability(contexts)
        left_over = ones * totals.pair[0] + twos * totals.pair[1] + more * totals.pair[2]
        before = each // len(chunk.words)
        whole = np.maximum(total[before], 1)
        p = np.where(
            total[before] > 0,
            (_discounted(counts, totals.pair) + left_over[before] * single[chunk.tokens]) / whole,
            single[chunk.tokens],
        )
        base = np.log10((seen[chunk.tokens] + 1) / (totals.tokens + totals.distinct + 1))
        at = chunk.bounds[:-1]
        return pa.table({
            "doc_id": pa.array(row["doc_id"], pa.int64()), "held_out": pa.array(row["held_out"], pa.bool_()),
            "n_tokens": pa.array(np.diff(chunk.bounds)),
            "n_known": pa.array(np.add.reduceat((seen[chunk.tokens] > 0).astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(at), totals.tokens)),
            "base_score": pa.array(np.add.reduceat(base, at)), "score": pa.array(np.add.reduceat(np.log10(p), at)),
        })
    return finish


def _hot_contexts(chunks: DataFrame, total: int, shards: int) -> np.ndarray:
    """Words with more than a quarter of a shard's share of all training tokens; at most 8 per shard."""
    if shards == 1:
        return _NONE
    share = 1.0 / (4 * min(shards, 1024))

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys, times = _keys(words), _unpack(counts)
                large = times >= share * max(times.sum(), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[large].astype(np.int64)), pa.array(times[large])], names=["word", "times"])

    found = chunks.select("words", "counts").mapInArrow(heavy, "word long, times long").groupBy("word").agg(
        F.sum("times").alias("times")).filter(F.col("times") >= share * total / 2).toArrow()
    return np.append(found["word"].to_numpy().astype(np.uint64), START)


def score(docs: DataFrame) -> DataFrame:
    """Log-probabilities of all rows of ``docs(doc_id, text, held_out)`` by the model of those not held out.

    ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``: tokens are lower-cased
    A-Z words and one end per text, so a null or empty text has one token. ``base_score`` is the
    add-one unigram's. Null ``held_out`` is false; a null doc_id keeps its row; repeated rows count
    and are scored each. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    chunks = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("held_out", F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(_encode, _CHUNKS))
    trained = chunks.agg(F.coalesce(F.sum("train_tokens"), F.lit(0)), F.count("*")).first()
    total, shards = int(trained[0]), max(1, -(-int(trained[0]) // SHARD_TOKENS))
    spread = _hot_contexts(chunks, total, shards)
    parts = cut_lineage(
        chunks.mapInArrow(_send_bigrams(shards, spread), _BIGRAMS)
        .groupBy("shard").applyInArrow(_bigram_shard(shards), _PARTS)
    )
    words = cut_lineage(
        chunks.select("chunk", "words", "counts").mapInArrow(_send_words(shards), _PARTS)
        .unionByName(parts.filter("kind IN ('w1', 'w2')"))
        .groupBy("shard").applyInArrow(_word_shard, _PARTS)
    )
    pair = _added(parts, "discount", 4)
    tokens, distinct, bigrams, *singles, more = _added(words, "totals", 8)
    single = discounts(*singles)
    back = single[0] * singles[0] + single[1] * singles[1] + single[2] * more
    totals = Totals(tokens, distinct, bigrams, discounts(*pair), single, back / bigrams if bigrams else 1.0)
    answers = parts.filter("kind = 'bigram'").unionByName(words.filter("kind = 'word'"))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(shards, spread, totals), _SCORES)


def _added(parts: DataFrame, kind: str, width: int) -> list[int]:
    """Sums of the few numbers that every shard reports."""

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_unpack(x, "<u8") for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(r[k]) for r in rows], pa.int64()) for k in range(width)], names=[f"n{k}" for k in range(width)])

    rows = parts.filter(F.col("kind") == kind).select("data").mapInArrow(numbers, ", ".join(f"n{k} long" for k in range(width)))
    return [int(x or 0) for x in rows.agg(*[F.sum(f"n{k}") for k in range(width)]).first()]
