import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from colsieve.llm import ngram_lm


def brute_force(docs):
    """Scores by dictionaries; docs of (key, text, held_out)."""
    tokens = [(k, (t or "").encode().lower().split() + [None], h) for k, t, h in docs]
    single, pair = Counter(), Counter()
    for _, w, held in tokens:
        if not held:
            single.update(w)
            pair.update(zip([0, *w], w, strict=False))
    count, distinct = sum(single.values()), len(single)
    levels = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
    d2 = (0, *ngram_lm.discounts(*levels(pair)))
    contexts, total, back = Counter(), Counter(), Counter()
    for (a, b), v in pair.items():
        contexts[b] += 1
        total[a] += v
        back[a] += d2[min(v, 3)]
    d1 = (0, *ngram_lm.discounts(*levels(contexts)))
    rest = sum(d1[min(v, 3)] for v in contexts.values())

    def word(w):
        if not pair:
            return 1 / (distinct + 1)
        return ((contexts[w] - d1[min(contexts[w], 3)] if contexts[w] else 0) + rest / (distinct + 1)) / len(pair)

    def chance(a, w):
        if not total[a]:
            return word(w)
        v = pair[a, w]
        return ((v - d2[min(v, 3)] if v else 0) + back[a] * word(w)) / total[a]

    out = []
    for key, w, held in tokens:
        score = sum(math.log10(chance(a, b)) for a, b in zip([0, *w], w, strict=False))
        base = sum(math.log10((single[x] + 1) / (count + distinct + 1)) for x in w)
        out.append((key, held, len(w), sum(x in single for x in w), count, base, score))
    assert sum(word(w) for w in single) + word("unseen") == pytest.approx(1.0)
    return out


def close(rows, want):
    key = lambda r: tuple(str(x) for x in r[:5])
    rows, want = sorted(map(tuple, rows), key=key), sorted(want, key=key)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    for r, w in zip(rows, want, strict=True):
        assert r[5:] == pytest.approx(w[5:])


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_scores_equal_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held_out"))
    close(ngram_lm.score(docs).collect(), brute_force([tuple(r) for r in docs.collect()]))


def test_many_chunks_and_shards_with_spread_contexts(spark, small, monkeypatch):
    monkeypatch.setattr(ngram_lm, "CHUNK_TOKENS", 2000)
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 5000)
    test_scores_equal_brute_force(spark, small)


def test_awkward_rows(spark, awkward, clashing, no_docs):
    for docs in (awkward, clashing):
        flagged = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)))
        want = brute_force([(r.doc_id, r.text, held(r.doc_id)) for r in docs.collect()])
        close(ngram_lm.score(flagged).collect(), want)
    assert ngram_lm.score(no_docs.withColumn("held_out", F.lit(False))).count() == 0
    unlearned = ngram_lm.score(awkward.withColumn("held_out", F.lit(True)))
    close(unlearned.collect(), brute_force([(r.doc_id, r.text, True) for r in awkward.collect()]))
