"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words, word pairs and pairs with one word between are hashed to ``BUCKETS`` coordinates and count
once per text. Every coordinate has its own learning rate, L1 keeps the weights of coordinates with
little evidence at exactly zero, and only the others are shipped to the scoring tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.llm import labelled, textscan
from colsieve.llm.store import remainder_is

BITS = 20
BUCKETS = 1 << BITS
PER_CLASS = 5000  # training texts of each label
ALPHA, BETA, L2 = 1.0, 1.0, 0.0
L1_PER_ROOT = 0.8  # L1 is this times the root of the texts with label 1, as chance sums grow
EPOCHS = 6
THRESHOLD = 0.3
_STRIP = np.zeros(256, bool)
_STRIP[list(b".,;:!?\"'()[]{}")] = True


def _coordinates(part: textscan.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all features of a slice, repeats included, and the document of each."""
    starts, ends = part.starts.copy(), part.ends.copy()
    for _ in range(3):  # words are hashed without the punctuation around them
        inner = ends - starts > 1
        starts += inner & _STRIP[part.data[starts]]
        inner = ends - starts > 1
        ends -= inner & _STRIP[part.data[ends - 1]]
    word = textscan.segment_hash(textscan.lower_values(part.data), starts, ends)
    owner = part.doc_of_word()
    found, docs = [word], [owner]
    for gap in (1, 2):
        if len(word) > gap:
            inside = owner[gap:] == owner[:-gap]
            found.append(textscan.mix(word[:-gap] * np.uint64(31) + word[gap:], gap)[inside])
            docs.append(owner[gap:][inside])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(docs)


def _feature_lists(texts: pa.Array) -> pa.Array:
    out = []
    for part in textscan.slices(texts):
        coordinates, docs = _coordinates(part)
        keys = np.unique(docs * BUCKETS + coordinates)
        bounds = np.searchsorted(keys, np.arange(part.count + 1) * BUCKETS)
        values = (keys % BUCKETS).astype(np.int32)
        out += [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.array(out, pa.binary())


class Ftrl:
    """Per-coordinate state of follow-the-regularised-leader; weights are derived from it."""

    def __init__(self, l1: float):
        self.l1 = l1
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)  # the last one is the bias

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        limit = np.where(at == BUCKETS, 0.0, self.l1)
        rate = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= limit, 0.0, (np.sign(z) * limit - z) / rate)

    def learn(self, at: np.ndarray, label: float, weight: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = (p - label) * weight
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


class Model:
    """The non-zero weights."""

    def __init__(self, places: np.ndarray, weights: np.ndarray, bias: float):
        self.places, self.weights, self.bias = places, weights, bias

    def scores(self, part: textscan.Slice) -> np.ndarray:
        coordinates, docs = _coordinates(part)
        spot = np.minimum(np.searchsorted(self.places, coordinates), max(len(self.places) - 1, 0))
        held = self.places[spot] == coordinates if len(self.places) else np.zeros(len(spot), bool)
        keys = np.unique(docs[held] * BUCKETS + coordinates[held])
        weight = self.weights[np.searchsorted(self.places, keys % BUCKETS)]
        total = self.bias + np.bincount(keys // BUCKETS, weight, part.count)
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", modulus: int = 4, held_out: int = 2) -> Model | None:
    """Learn document labels 0 and 1 from a bounded sample; None unless both occur."""
    rows = labelled.training_labels(labels, column, modulus, held_out).filter("label IN (0, 1)")
    sample = labelled.training_texts(docs, rows, PER_CLASS)
    extract = F.arrow_udf(_feature_lists, "binary")
    found = sample.select("label", "weight", extract(F.coalesce("text", F.lit(""))).alias("bag")).toArrow().to_pydict()
    if len(set(found["label"])) < 2:
        return None
    order = sorted(range(len(found["label"])), key=lambda i: (found["label"][i], found["bag"][i]))
    bags = [np.append(np.frombuffer(found["bag"][i], np.int32).astype(np.int64), BUCKETS) for i in order]
    label = [float(found["label"][i]) for i in order]
    weight = [found["weight"][i] for i in order]
    least = min(weight)
    state, rng = Ftrl(L1_PER_ROOT * sum(label) ** 0.5), np.random.default_rng(17)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            state.learn(bags[i], label[i], min(weight[i] / least, 10.0))
    whole = state.weights(np.arange(BUCKETS + 1))
    places = np.flatnonzero(whole[:-1])
    return Model(places, whole[places], float(whole[-1]))


def score(model: Model | None, text: Column) -> Column:
    """Score of 0 to 1; 0 everywhere without a model. Null text counts as empty."""
    if model is None:
        return F.lit(0.0)

    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(model.scores(p) for p in textscan.slices(texts))]))

    return F.arrow_udf(scored, "double")(F.coalesce(text.cast("string"), F.lit("")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs(doc_id, text)``.

    Labels of ids that ``docs`` lacks and contradictory labels teach nothing. Other columns of either
    table are ignored.
    """
    model = fit(docs, labels)
    return docs.select(
        "doc_id", remainder_is(F.col("doc_id"), 4, 2).alias("held_out"), score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
