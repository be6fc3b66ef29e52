"""Language identification by a string kernel.

Two texts are as similar as their sets of byte n-grams (one to three bytes, hashed to ``BUCKETS``)
overlap: |A & B| / sqrt(|A| |B|). Nystroem landmarks turn the kernel into features, one-versus-rest
ridge regression fits one function per language, and texts are scored block by block as matrix
products with the landmarks and then the weights.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colsieve.llm import labelled, textscan
from colsieve.llm.store import remainder_is

ORDERS = (1, 2, 3)
BITS = 14
BUCKETS = 1 << BITS
PER_LANGUAGE = 400  # training texts of each language; all languages together have SAMPLE at most
SAMPLE = 8000
LANDMARKS = 160
RIDGE = 1e-2
SHARPNESS = 5.0
UNKNOWN = "und"
MIN_SCORE = 0.3  # below it the pipeline rejects a document
_BLOCK = 256


def presence(part: textscan.Slice) -> np.ndarray:
    """Which n-grams each document holds, as a matrix of bytes 0 and 1."""
    out = np.zeros(part.count * BUCKETS, np.uint8)
    data = part.data.astype(np.uint32)
    owner = np.repeat(np.arange(part.count, dtype=np.int64) * BUCKETS, np.diff(part.doc_bytes))
    codes = np.zeros(len(data), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        count = len(data) - order + 1
        if count <= 0:
            break
        codes = (codes[:count] << np.uint32(8)) | data[order - 1:]
        if order in ORDERS:
            bucket = ((codes + np.uint32(order)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            inside = owner[:count] == owner[order - 1:]
            out[(owner[:count] + bucket)[inside]] = 1
    return out.reshape(part.count, BUCKETS)


def _overlap(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    left, right = left.astype(np.float32), right.astype(np.float32)
    sizes = np.sqrt(np.maximum(left.sum(1), 1))[:, None] * np.sqrt(np.maximum(right.sum(1), 1))[None, :]
    return (left @ right.T) / sizes


class Model:
    """Landmark sets and one weight column per language."""

    def __init__(self, languages: list[str], landmarks: np.ndarray, weights: np.ndarray):
        self.languages, self.bits, self.weights = languages, np.packbits(landmarks, axis=1), weights
        self._ready: tuple | None = None

    def __getstate__(self):
        return {**self.__dict__, "_ready": None}

    def score(self, sets: np.ndarray) -> np.ndarray:
        """Probability-like shares of the languages, one row per set."""
        if self._ready is None:
            landmarks = np.unpackbits(self.bits, axis=1).astype(np.float32)
            norms = np.sqrt(np.maximum(landmarks.sum(1), 1))
            self._ready = (np.ascontiguousarray((landmarks / norms[:, None]).T),)
        x = sets.astype(np.float32)
        kernel = (x @ self._ready[0]) / np.sqrt(np.maximum(x.sum(1), 1))[:, None]
        raw = SHARPNESS * (kernel @ self.weights)
        raw = np.exp(raw - raw.max(axis=1, keepdims=True))
        return raw / raw.sum(axis=1, keepdims=True)


def _bits(texts: pa.Array) -> pa.Array:
    rows = [np.packbits(presence(p), axis=1) for p in textscan.slices(texts, most=_BLOCK)]
    flat = np.concatenate(rows) if rows else np.zeros((0, BUCKETS // 8), np.uint8)
    return pa.array([row.tobytes() for row in flat], pa.binary())


def _lowered(text: Column) -> Column:
    return F.lower(F.coalesce(text.cast("string"), F.lit("")))


def fit(docs: DataFrame, modulus: int = 5, held_out: int = 0) -> Model | None:
    """Learn from text and non-null lang of rows outside the held-out fold; None without any."""
    rows = labelled.training_labels(docs, "lang", modulus, held_out)
    languages = rows.filter("label IS NOT NULL").select("label").distinct().count()
    if not languages:
        return None
    sample = labelled.training_texts(docs, rows, max(1, min(PER_LANGUAGE, SAMPLE // languages)))
    extract = F.arrow_udf(_bits, "binary")
    found = sample.select("label", extract(_lowered(F.col("text"))).alias("bits")).toArrow().to_pydict()
    names = sorted(set(found["label"]))
    if not names:
        return None
    order = sorted(range(len(found["label"])), key=lambda i: (found["label"][i], found["bits"][i]))
    sets = np.unpackbits(np.frombuffer(b"".join(found["bits"][i] for i in order), np.uint8)).reshape(-1, BUCKETS)
    kind = np.array([names.index(found["label"][i]) for i in order])
    picked = np.random.default_rng(11).permutation(len(kind))
    each = max(1, LANDMARKS // len(names))
    marks = np.concatenate([picked[kind[picked] == k][:each] for k in range(len(names))])
    landmarks = sets[np.sort(marks)]
    own = _overlap(landmarks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh(own)
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    features = np.concatenate([
        _overlap(sets[at: at + 512], landmarks) for at in range(0, len(sets), 512)]).astype(np.float64) @ half
    share = 1.0 / np.bincount(kind, minlength=len(names))[kind]  # languages weigh the same
    target = np.where(kind[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = features.T @ (features * share[:, None]) + RIDGE * np.eye(features.shape[1])
    beta = np.linalg.solve(gram, features.T @ (target * share[:, None]))
    return Model(names, landmarks, (half @ beta).astype(np.float32))


def prediction(model: Model | None, text: Column) -> Column:
    """Struct ``(lang, score)``: ``und`` and 0 where the text is null or has no letter."""
    kind = "struct<lang: string, score: double>"
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))

    def predict(texts: pa.Array) -> pa.Array:
        best, top = [], []
        for part in textscan.slices(texts, most=_BLOCK):
            shares = model.score(presence(part))
            best.append(shares.argmax(axis=1))
            top.append(shares.max(axis=1))
        names = np.array(model.languages, object)
        lang = pa.array(names[np.concatenate(best)] if best else [], pa.string())
        score = pa.array(np.concatenate(top).astype(np.float64) if top else [], pa.float64())
        return pa.StructArray.from_arrays([lang, score], ["lang", "score"])

    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    return F.when(known, F.arrow_udf(predict, kind)(_lowered(text))).otherwise(unknown)


def identify(docs: DataFrame, fitted: Callable[[DataFrame], Model | None] = fit) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs(doc_id, text, lang)``.

    Null or letterless texts are ``und`` with score 0, as is everything where no row has a language.
    A null doc_id isn't held out and isn't learned from. Other columns are ignored.
    """
    model = fitted(docs)
    return docs.select("doc_id", "text").select(
        "doc_id", remainder_is(F.col("doc_id"), 5, 0).alias("held_out"),
        prediction(model, F.col("text")).alias("found"),
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is known with at least this score."""
    return docs.filter(prediction(fit(docs), F.col("text"))["score"] >= min_score)
