import zlib

import numpy as np
import pyarrow as pa
import pytest

from colsieve.llm import labelled, language, passages, textscan, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def fold(doc_id, modulus, value):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == value


def accuracy(out, truth):
    held = [r for r in out if r.held_out and truth.get(r.doc_id) is not None]
    assert held
    return sum(r.predicted == truth[r.doc_id] for r in held) / len(held)


def test_language_accuracy_on_held_out(tables):
    docs, _ = tables
    truth = {r.doc_id: r.lang for r in docs.collect()}
    out = language.identify(docs).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == fold(r.doc_id, 5, 0) for r in out)
    held = [r for r in out if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_quality_accuracy_on_held_out(tables):
    docs, labels = tables
    out = passages.classify(docs, labels).collect()
    assert all(r.held_out == fold(r.doc_id, 5, 0) and r.predicted == (r.score >= 0.3) for r in out)
    assert accuracy(out, {r.doc_id: r.quality for r in labels.collect()}) > 0.95


def test_toxicity_accuracy_on_held_out(tables):
    docs, labels = tables
    out = toxicity.classify(docs, labels).collect()
    assert all(r.held_out == fold(r.doc_id, 4, 2) and r.predicted == (r.score >= 0.3) for r in out)
    assert accuracy(out, {r.doc_id: r.toxic for r in labels.collect()}) > 0.88


def test_held_out_labels_teach_nothing(spark, tables):
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "IF(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) AS quality", "toxic")
    some = docs.filter("doc_id < 300")
    a, b = (sorted((r.doc_id, r.score) for r in passages.classify(some, x).collect()) for x in (labels, flipped))
    assert a == b


def test_overlap_kernel_equals_sets():
    texts = ["abcabc", "bcd", "", "zz"]
    part = next(textscan.slices(pa.array(texts)))
    sets = language.presence(part)
    grams = [{t.encode()[i:i + n] for n in language.ORDERS for i in range(len(t) - n + 1)} for t in texts]
    assert sets.sum(1).tolist() == [len(g) for g in grams]  # no collisions among these few
    kernel = language._overlap(sets, sets)
    for i, a in enumerate(grams):
        for j, b in enumerate(grams):
            assert kernel[i, j] == pytest.approx(len(a & b) / max((len(a) * len(b)) ** 0.5, 1), abs=1e-6)


def test_attention_gradients_by_differences():
    rng = np.random.default_rng(2)
    model = passages.Model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    raw, bounds = rng.normal(size=(7, passages.WIDTH)) * 0.3, np.array([0, 2, 3, 7])
    label, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        y = model.forward(raw, bounds)["y"]
        return -(weight * (label * np.log(y) + (1 - label) * np.log(1 - y))).sum() / weight.sum()

    grads = model.gradients(raw, bounds, label, weight)
    for name, value in model.p.items():
        at = tuple(rng.integers(0, n) for n in value.shape)
        kept, step = value[at], 1e-5
        value[at] = kept + step
        high = loss()
        value[at] = kept - step
        low = loss()
        value[at] = kept
        assert grads[name][at] == pytest.approx((high - low) / (2 * step), rel=2e-3, abs=1e-6), name


def test_every_passage_counts():
    text = " ".join(f"w{k}" for k in range(1000))
    features, bounds = passages.encode(next(textscan.slices(pa.array([text, "", "a b"]))))
    assert np.diff(bounds).tolist() == [16, 1, 1] and np.isfinite(features).all()
    shouting = text + " " + "LOUD!! " * 64
    more, _ = passages.encode(next(textscan.slices(pa.array([shouting]))))
    assert np.abs(more[-1] - features[15]).max() > 0.1


def test_l1_leaves_unseen_and_rare_coordinates_at_zero():
    state = toxicity.Ftrl(l1=3.0)
    rare, bias = 5, toxicity.BUCKETS
    for k in range(200):
        label = float(k % 2)
        state.learn(np.array(([7] if label else [8]) + ([rare] if k == 3 else []) + [bias]), label, 1.0)
    weights = state.weights(np.array([7, 8, rare, 9]))
    assert weights[0] > 0.5 and weights[1] < -0.5 and weights[2] == 0 and weights[3] == 0


def test_chosen_ids_are_bounded_and_skip_contradictions(spark):
    rows = [(k, k % 2) for k in range(4000)] + [(1, 0), (None, 1), (7, None)]
    picked = labelled.chosen(spark.createDataFrame(rows, "doc_id long, label int"), 200).collect()
    assert 300 < len(picked) < 500 and 1 not in {r.doc_id for r in picked} and None not in {r.doc_id for r in picked}


@pytest.mark.parametrize("operator", [language.identify, passages.classify, toxicity.classify])
def test_awkward_rows(operator, awkward, clashing, no_docs, labels):
    more = () if operator is language.identify else (labels,)
    for docs in (awkward, clashing):
        out = operator(docs, *more).collect()
        assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
        if operator is language.identify:
            unknown = {r.doc_id for r in out if r.lang_pred == "und"}
            assert unknown == {4, 5, 6, 11, 12}
    assert operator(no_docs, *more).count() == 0
    none = operator(awkward.filter("lang IS NULL"), *(x.filter("false") for x in more)).collect()
    assert len(none) == awkward.filter("lang IS NULL").count()


def test_filters_keep_columns(clashing, labels):
    assert language.keep_identified(clashing).columns == clashing.columns
    kept = passages.keep_good(clashing, labels)
    assert kept.columns == clashing.columns and kept.count() <= clashing.count()
