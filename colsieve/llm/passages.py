"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded from its byte-class
pairs, word shapes and repetition by a learned layer; gated attention, learned from document labels
alone, weighs the passages, and the weighted representation gives the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.llm import labelled, textscan
from colsieve.llm.store import remainder_is

PASSAGE = 64
PER_CLASS = 2500  # training documents of each label
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.01, 1e-4
THRESHOLD = 0.3
_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", ".,;:'\"-()",
           "!?", "#*$%&<>|=~^_+/\\", "@[]{}`")
_CLASSES = len(_GROUPS) + 1  # the last holds bytes of other characters
_CLASS_OF = np.full(256, len(_GROUPS), np.uint8)
for _k, _group in enumerate(_GROUPS):
    _CLASS_OF[list(_group.encode())] = _k
WIDTH = _CLASSES * _CLASSES + 6


def encode(part: textscan.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and passage bounds per document; each document has one at least."""
    words = np.diff(part.doc_words)
    counts = np.maximum(-(-words // PASSAGE), 1)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    first = np.repeat(part.doc_words[:-1] - bounds[:-1] * PASSAGE, counts) + np.arange(bounds[-1]) * PASSAGE
    last = np.minimum(first + PASSAGE, np.repeat(part.doc_words[1:], counts))
    total = len(first)
    kinds = _CLASS_OF[part.data].astype(np.int64)
    # a passage lasts until the next one starts; a document's first starts with the document
    opens = np.append(part.starts, len(part.data))[first]
    opens[bounds[:-1]] = part.doc_bytes[:-1]
    place = np.cumsum(np.bincount(opens, minlength=len(part.data) + 1))[: len(part.data)] - 1
    pairs = np.zeros((total, _CLASSES * _CLASSES))
    if len(kinds) > 1:
        same = place[1:] == place[:-1]
        codes = (place[:-1] * _CLASSES + kinds[:-1]) * _CLASSES + kinds[1:]
        pairs = np.bincount(codes[same], minlength=total * _CLASSES * _CLASSES).reshape(total, -1).astype(float)
    pairs /= np.maximum(pairs.sum(1, keepdims=True), 1)
    size = np.maximum(last - first, 1)
    lengths = (part.ends - part.starts).astype(float)
    owner = np.repeat(np.arange(total), last - first)
    mean = np.bincount(owner, lengths, total) / size
    spread = np.sqrt(np.maximum(np.bincount(owner, lengths**2, total) / size - mean**2, 0))
    hashes = part.hashes()
    _, distinct = textscan.distinct(hashes, np.append(first, last[-1:])) if len(hashes) else (None, np.zeros(total + 1))
    _, in_doc = textscan.distinct(hashes, part.doc_words)
    fresh = np.repeat(np.diff(in_doc) / np.maximum(words, 1), counts)
    extra = np.stack([
        mean / 10, spread / 10, np.diff(distinct) / size, fresh, (last - first) / PASSAGE,
        np.log1p(np.repeat(words, counts)) / 10,
    ], axis=1)
    return np.hstack([np.sqrt(pairs), extra]).astype(np.float32), bounds


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, bounds[:-1], axis=0)


class Model:
    """Encoder, gated attention and output, as one dictionary of arrays."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)

        def draw(a: int, b: int) -> np.ndarray:
            return (rng.normal(size=(a, b)) / np.sqrt(a)).astype(np.float32)

        self.p = {
            "W": draw(WIDTH, HIDDEN) * 3, "b": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, GATE),
            "U": draw(HIDDEN, GATE), "w": draw(GATE, 1), "c": draw(HIDDEN, 1), "c0": np.zeros(1, np.float32),
        }
        self.mean, self.scale = np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32)

    def forward(self, raw: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes = self.p, np.diff(bounds)
        x = (raw - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        v, u = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (v * u) @ p["w"]
        top = np.maximum.reduceat(e, bounds[:-1], axis=0)
        a = np.exp(e - np.repeat(top, sizes, axis=0))
        a /= np.repeat(_sum(a, bounds), sizes, axis=0)
        z = _sum(a * h, bounds)
        return {"x": x, "h": h, "v": v, "u": u, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["c0"])[:, 0]}

    def gradients(self, raw: np.ndarray, bounds: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
        p, f, sizes = self.p, self.forward(raw, bounds), np.diff(bounds)
        dy = ((f["y"] - label) * weight / weight.sum())[:, None].astype(np.float32)
        dz = np.repeat(dy @ p["c"].T, sizes, axis=0)
        da = (dz * f["h"]).sum(1, keepdims=True)
        de = f["a"] * (da - np.repeat(_sum(f["a"] * da, bounds), sizes, axis=0))
        gate = de @ p["w"].T
        dv, du = gate * f["u"] * (1 - f["v"] ** 2), gate * f["v"] * f["u"] * (1 - f["u"])
        dh = (dz * f["a"] + dv @ p["V"].T + du @ p["U"].T) * (1 - f["h"] ** 2)
        return {
            "W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
            "w": (f["v"] * f["u"]).T @ de, "c": f["z"].T @ dy, "c0": dy.sum(0),
        }


def _packed(texts: pa.Array) -> pa.Array:
    out = []
    for part in textscan.slices(texts):
        features, bounds = encode(part)
        out += [features[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.array(out, pa.binary())


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", modulus: int = 5, held_out: int = 0) -> Model | None:
    """Learn document labels 0 and 1 from a bounded sample; None unless both occur."""
    rows = labelled.training_labels(labels, column, modulus, held_out).filter("label IN (0, 1)")
    sample = labelled.training_texts(docs, rows, PER_CLASS)
    extract = F.arrow_udf(_packed, "binary")
    found = sample.select("label", "weight", extract(F.coalesce("text", F.lit(""))).alias("bag")).toArrow().to_pydict()
    order = sorted(range(len(found["label"])), key=lambda i: (found["label"][i], found["bag"][i]))
    label = np.array([found["label"][i] for i in order], np.float32)
    if len(set(label.tolist())) < 2:
        return None
    bags = [np.frombuffer(found["bag"][i], np.float32).reshape(-1, WIDTH) for i in order]
    weight = np.array([found["weight"][i] for i in order], np.float32)
    model, rng = Model(), np.random.default_rng(3)
    whole = np.concatenate(bags)
    model.mean, model.scale = whole.mean(0), whole.std(0) + 0.02
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second, step = {k: np.zeros_like(v) for k, v in model.p.items()}, 0
    for _ in range(EPOCHS):
        turn = rng.permutation(len(bags))
        for at in range(0, len(turn), BATCH):
            some, step = turn[at: at + BATCH], step + 1
            bounds = np.concatenate(([0], np.cumsum([len(bags[i]) for i in some])))
            grads = model.gradients(np.concatenate([bags[i] for i in some]), bounds, label[some], weight[some])
            for k, grad in grads.items():
                grad = grad + DECAY * model.p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                model.p[k] = (model.p[k] - RATE * move).astype(np.float32)
    return model


def score(model: Model | None, text: Column) -> Column:
    """Score of 0 to 1; 0.5 everywhere without a model. Null text counts as empty, one empty passage."""
    if model is None:
        return F.lit(0.5)

    def scored(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for part in textscan.slices(texts):
            out.append(model.forward(*encode(part))["y"].astype(np.float64))
        return pa.array(np.concatenate(out))

    return F.arrow_udf(scored, "double")(F.coalesce(text.cast("string"), F.lit("")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs(doc_id, text)``.

    Labels of ids that ``docs`` lacks and contradictory labels teach nothing. Other columns of either
    table are ignored.
    """
    model = fit(docs, labels)
    return docs.select(
        "doc_id", remainder_is(F.col("doc_id"), 5, 0).alias("held_out"), score(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold."""
    return docs.filter(score(fit(docs, labels), F.col("text")) >= THRESHOLD)
