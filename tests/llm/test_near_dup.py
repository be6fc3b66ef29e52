import random

import numpy as np
import pyarrow as pa

from colsieve.llm import near_dup, textscan


def brute_force(docs):
    sets = {}
    for doc_id, text in docs:
        w = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_groups_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    docs = []
    for k in range(60):
        base = rng.choices(vocabulary, k=rng.randint(1, 120))
        docs.append((len(docs), " ".join(base)))
        for _ in range(rng.choice((0, 0, 1, 4))):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append((len(docs), " ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
    shared = rng.choices(vocabulary, k=60)  # a passage that many share without being copies
    docs += [(len(docs) + k, " ".join(shared + rng.choices(vocabulary, k=40))) for k in range(40)]
    out = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute_force(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_star_of_near_copies_whose_hub_is_not_first(spark):
    """Copies differ too much from each other; only the last document links them all."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(400)]
    docs = []
    for k in range(30):
        copy = list(base)
        for at in range(3 + k % 5, 400, 40):
            copy[at] = f"x{k}_{at}"
        docs.append((k, " ".join(copy)))
    docs.append((99, " ".join(base)))
    rng.shuffle(docs)
    out = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute_force(docs)


def test_bucket_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    test_star_of_near_copies_whose_hub_is_not_first(spark)


def test_estimate_takes_chance_matches_off():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    for share in (0.0, 0.5, 0.8):
        common = int(len(a) * 2 * share / (1 + share))
        b = np.concatenate((a[:common], rng.integers(0, 2**63, len(a) - common, dtype=np.uint64)))
        packed = [near_dup.pack(near_dup.minima(x, np.array([0]))) for x in (a, b)]
        assert abs(near_dup.estimate(*packed)[0, 0] - share) < 0.17


def test_packing_keeps_the_low_bits():
    least = np.random.default_rng(1).integers(0, 2**32, (3, near_dup.BANDS * near_dup.ROWS), dtype=np.uint32)
    packed = near_dup.pack(least)
    for k in (0, 31, 32, 199):
        word, place = divmod(k, 64 // near_dup.BITS)
        assert ((packed[:, word] >> np.uint64(place * near_dup.BITS)) & np.uint64(3) == least[:, k] & 3).all()


def test_awkward_rows(spark, awkward, clashing, no_docs):
    rows = {(r.doc_id, r.n_shingles): r for r in near_dup.near_duplicates(awkward).collect()}
    assert near_dup.near_duplicates(awkward).count() == awkward.count()
    assert rows[(2, 56)].component_id == 1 and not rows[(2, 56)].kept
    assert rows[(3, 57)].component_id == 1
    assert rows[(4, 0)].kept and rows[(6, 0)].component_id == 6
    assert rows[(8, 1)].component_id == 7
    assert rows[(None, 56)].component_id is None and rows[(None, 56)].kept
    assert near_dup.near_duplicates(no_docs).count() == 0
    kept = near_dup.keep_one_of_each_group(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(10) == 1 and ids.count(None) == 2 and 2 not in ids and 1 in ids


def test_slices_agree_with_one_scan():
    texts = pa.array(["a b  c", None, "", "x" * 50, " lead and trail ", "d\ne"])
    whole = next(textscan.slices(texts))
    parts = list(textscan.slices(texts, limit=4))
    assert np.concatenate([p.hashes() for p in parts]).tolist() == whole.hashes().tolist()
    assert np.diff(whole.doc_words).tolist() == [3, 0, 0, 1, 3, 2]
    assert whole.hashes()[0] != whole.hashes()[1]


def words(start, count):
    return " ".join(f"word{k}x{k * 7919 % 97}" for k in range(start, start + count))


def plain(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_ids_with_different_texts_link_through_them(spark):
    a, b = words(0, 60), words(500, 60)
    rows = [(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (4, words(900, 60)), (5, b), (5, words(900, 60) + " tail")]
    want = [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (5, 1)]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        assert plain(near_dup.near_duplicates(spark.createDataFrame(order, "doc_id long, text string")), "doc_id", "component_id") == want
    apart = [(7, words(k * 100, 50)) for k in range(5)] + [(8, words(200, 50) + " end"), (9, words(3000, 50))]
    assert plain(near_dup.near_duplicates(spark.createDataFrame(apart, "doc_id long, text string")), "doc_id", "component_id") == [
        *[(7, 7)] * 5, (8, 7), (9, 9)]


def test_map_columns_are_kept(spark):
    rows = [(1, words(0, 60), {"k": 1}), (1, words(0, 60), {"k": 2}), (2, words(0, 60), None), (3, words(300, 60), {})]
    kept = near_dup.keep_one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>"))
    assert [(r["doc_id"], r["extra"]) for r in kept.orderBy("doc_id").collect()] == [(1, {"k": 1}), (3, {})]
