import random

import numpy as np
import pyarrow as pa
import pytest

from colsieve.llm import decontaminate, textscan


@pytest.fixture(scope="module")
def index():
    rng = random.Random(5)
    common, rare = [f"c{k}" for k in range(30)], [f"r{k}" for k in range(2000)]
    draw = lambda n: [rng.choice(common if rng.random() < 0.5 else rare) for _ in range(n)]
    items = [(k, " ".join(draw(rng.randint(3, 50)))) for k in range(120)]
    return decontaminate.Index(items), items, draw, rng


def brute_force(index, terms, threshold):
    scores = {}
    for t in terms:
        for i, w in zip(index.items[t].tolist(), index.impacts[t].tolist(), strict=True):
            scores[i] = scores.get(i, 0.0) + w
    return {i: s for i, s in scores.items() if s >= threshold - 1e-9}


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.4, 0.8])
def test_block_max_wand_returns_all_above_the_threshold(index, threshold):
    held, items, draw, rng = index
    for _ in range(60):
        text = " ".join(draw(60) + (rng.choice(items)[1].split()[: rng.randint(1, 50)]))
        terms = sorted({t for t in held.term_of(next(textscan.slices(pa.array([text]))).hashes()).tolist() if t >= 0})
        found = dict(held.retrieve(terms, threshold))
        want = brute_force(held, terms, threshold)
        assert found.keys() == want.keys()
        assert all(found[i] == pytest.approx(want[i]) for i in want)


def test_an_item_scores_one_against_itself(index):
    held, items, _, _ = index
    for n, (item, text) in enumerate((i, t) for i, t in items if len(t.split()) >= 5):
        terms = sorted(set(held.term_of(next(textscan.slices(pa.array([text]))).hashes()).tolist()))
        assert dict(held.retrieve(terms, 0.99))[n] == pytest.approx(1.0)
        assert held.ids[n] == item


def test_first_lookup_drops_no_match(index):
    """Items anywhere in long texts, whole or cut, are found as by looking at all shingles."""
    held, items, draw, rng = index
    texts = []
    for k in range(80):
        own = rng.choice(items)[1].split()
        cut = own[: max(1, int(len(own) * rng.choice((1.0, 1.0, 0.9, 0.7, 0.5))))]
        texts.append(" ".join(draw(rng.randint(0, 400)) + cut + draw(rng.randint(0, 300))))
    got = [r for part in textscan.slices(pa.array(texts)) for r in held.leaks(part)]
    shingles = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    for text, found in zip(texts, got, strict=True):
        own, want = shingles(text.split()), set()
        for item, body in items:
            w = body.split()
            if len(w) < 5:
                continue
            at = len(w) - max(1, len(w) // 4)
            answer = {tuple(w[i:i + 5]) for i in range(len(w) - 4) if i + 4 >= at}
            question = shingles(w) - answer
            q, a = len(question & own), len(answer & own)
            if q + a >= 0.75 * len(question | answer) and q >= 0.5 * len(question) and a >= 0.5 * len(answer):
                want.add(item)
        assert {f[0] for f in found} == want


def test_question_mark_parts_question_and_answer():
    assert decontaminate._answer_at("who wrote it? the old man", 6) == 3
    assert decontaminate._answer_at("who wrote it?", 3) == 2
    assert decontaminate._answer_at(" ".join("abcdefgh"), 8) == 6


def test_shards_find_what_one_index_finds(spark, small, monkeypatch):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    one = sorted(map(tuple, decontaminate.leaked(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 7)
    many = sorted(map(tuple, decontaminate.leaked(docs, items).collect()))
    assert one == many and one
    clean = decontaminate.keep_clean(docs, items)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()} == {r[0] for r in one}


def test_awkward_rows(spark, awkward, clashing, no_docs):
    text = " ".join(awkward.filter("doc_id = 1").first().text.split()[5:30])
    items = spark.createDataFrame(
        [(1, text, 0.5), (1, text, 0.7), (2, None, 0.1), (None, text, 0.1), (3, "", 0.1), (4, "one two", 0.1)],
        "item_id long, text string, doc_id double")
    found = decontaminate.leaked(clashing, items).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 1), ("2", 1), ("3", 1), ("None", 1)]
    assert decontaminate.keep_clean(clashing, items).columns == clashing.columns
    assert decontaminate.leaked(no_docs, items).count() == 0
    assert decontaminate.leaked(awkward, items.filter("false")).count() == 0


def test_retrieval_reads_places_without_numpy_calls(monkeypatch):
    """Most of the operator's time went into NumPy calls on lists of a few places."""
    texts = [" ".join(f"w{(k * 7 + j * j) % 40}" for j in range(12)) for k in range(60)]
    index = decontaminate.Index(list(enumerate(texts)))
    part = next(textscan.slices(pa.array(texts)))
    terms = np.unique(index.term_of(part.hashes())).tolist()
    scores = np.zeros(len(index.ids))
    for t in terms:
        scores[index.items[t]] += index.impacts[t]
    want = [(i, round(float(s), 9)) for i, s in enumerate(scores) if s >= 0.4]

    def none(*_):
        raise AssertionError("a NumPy call for one place")

    monkeypatch.setattr(decontaminate.np, "searchsorted", none)
    got = index.retrieve(terms)
    assert [(i, round(s, 9)) for i, s in got] == want and len(want) == 60
    assert index.retrieve(terms, 1.5) == []
