"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL.

A text's features are hashed n-grams of its words (1 and 2) and of the words' shapes
(1 to 3), where a shape keeps punctuation and reduces letters and digits to runs, and
marks a word that repeats the one before. Each n-gram weighs the square root of its
count; a text's vector has length one. Training is one pass or more of
follow-the-regularised-leader updates; the L1 term leaves most weights at zero, so
scoring is a sparse dot product per text.

Defined results. Null or empty text has the bias alone. Null ids are not held out and
teach nothing. Repeated rows are scored each. With no usable label, or one class only,
every score is the share of good labels, or one half without any. Extra columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from civicloom.llm.common import held_out, labelled_sample, text_of

BITS = 18
#: The bounded sample that the model is fitted on, by the smallest hash of the id.
MAX_TRAINING_ROWS = 10_000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.001
THRESHOLD = 0.7
_KNOWN_WORDS = 200_000

_RUNS = (
    (re.compile(rb"[A-Z]+(?![a-z\x80-\xff])"), b"A"),
    (re.compile(rb"[A-Z]?[a-z\x80-\xff]+"), b"a"),
    (re.compile(rb"[0-9]+"), b"0"),
)
_MIX = np.uint32(0x9E3779B1)


def _shape(word: bytes) -> bytes:
    for pattern, mark in _RUNS:
        word = pattern.sub(mark, word)
    return word


class Features:
    """Texts as ``indices, values`` of a sparse vector. Remembers the hashes of words it has met."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[int, int]] = {}

    def _word(self, word: bytes) -> tuple[int, int]:
        if len(self.known) >= _KNOWN_WORDS:
            self.known.clear()
        pair = self.known[word] = (zlib.crc32(word.lower()), zlib.crc32(_shape(word), 1))
        return pair

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.encode().split()
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        known = self.known
        pairs = np.array([known.get(w) or self._word(w) for w in words], dtype=np.uint32)
        word, shape = pairs[:, 0], pairs[:, 1].copy()
        shape[1:][word[1:] == word[:-1]] ^= np.uint32(0x5BD1E995)
        with np.errstate(over="ignore"):
            two = (shape[:-1] * _MIX) ^ shape[1:]
            grams = np.concatenate(
                [word, (word[:-1] * _MIX) ^ word[1:], shape + np.uint32(2), two + np.uint32(3), ((two[:-1] * _MIX) ^ shape[2:]) + np.uint32(4)]
            )
            grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - BITS)
        index, count = np.unique(grams, return_counts=True)
        value = np.sqrt(count)
        return index.astype(np.int32), (value / np.sqrt(count.sum())).astype(np.float32)


class Ftrl:
    """Per-coordinate FTRL-proximal for the logistic loss; the last coordinate is the bias, without L1."""

    def __init__(self, size: int) -> None:
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, index: np.ndarray) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        l1 = np.where(index == len(self.z) - 1, 0.0, L1)
        free = np.maximum(np.abs(z) - l1, 0)
        return -np.sign(z) * free / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def update(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        index, value = np.append(index, len(self.z) - 1), np.append(value, 1.0)
        w = self.weights(index)
        gradient = (_logistic(w @ value) - label) * value
        sigma = (np.sqrt(self.n[index] + gradient**2) - np.sqrt(self.n[index])) / ALPHA
        self.z[index] += gradient - sigma * w
        self.n[index] += gradient**2


def _logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def fit(rows: list[tuple[str, int]]) -> np.ndarray:
    """Weights and bias."""
    labels = [label for _, label in rows]
    good = sum(labels)
    if good in (0, len(labels)):
        share = good / len(labels) if labels else 0.5
        return np.append(np.zeros(1 << BITS), np.log(max(share, 1e-9) / max(1 - share, 1e-9))).astype(np.float32)
    features, model = Features(), Ftrl(1 << BITS)
    vectors = [features(text) for text, _ in rows]
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            model.update(*vectors[i], labels[i])
    return model.weights(np.arange((1 << BITS) + 1)).astype(np.float32)


def scores(texts: list[str], weights: np.ndarray, features: Features) -> list[float]:
    found = []
    for text in texts:
        index, value = features(text)
        found.append(_logistic(float(weights[index] @ value) + float(weights[-1])))
    return found


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> np.ndarray:
    """Fits on the bounded sample in one task; the weights, ``2 ** BITS + 1`` numbers, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (order, text, label)
            for b in batches
            for order, text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist())
        )
        yield pa.RecordBatch.from_arrays([pa.array([fit([r[1:] for r in rows]).tobytes()], pa.binary())], ["weights"])

    sample = labelled_sample(docs, labels, "quality", max_rows).select("doc_id", "text", "label")
    model = sample.coalesce(1).mapInArrow(run, "weights binary").first()
    return np.frombuffer(model["weights"], np.float32) if model else fit([])  # no partition, no task


def scorer(spark: SparkSession, weights: np.ndarray) -> Callable[[Column], Column]:
    """A column function that scores texts."""
    model = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def of(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in frames:
            yield pd.Series(scores(texts.tolist(), model.value, features), dtype="float64")

    return of


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows the classifier doesn't reject, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return docs.filter(score(text_of()) >= THRESHOLD)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    score = scorer(docs.sparkSession, train(docs, labels))
    scored = docs.select("doc_id", score(text_of()).alias("score"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
