"""Toxic passages by maximum-scoring segments of token log-odds.

A token is a word; it counts with its stems, its first bytes, so that forms of a word
that are rare each still add up. A token's score is a lower bound of the log-odds of its rate in toxic against other
texts, each under a Dirichlet prior with the corpus' own word rates, less a drift that
makes ordinary text score below zero. One linear scan finds every maximal scoring segment; within
one, a word counts once. With lambda from
the corpus' word rates and K from non-toxic training texts, a segment's score becomes
the number E of such segments that chance would put in a text of that length. A text's
statistic adds up -ln E of its significant segments, and a logistic curve fitted on the
training rows turns it into a score.

Defined results. Null or empty text has no token, so the score of statistic zero. Null
ids are not held out and teach nothing. Repeated rows are scored each. With no usable
label, or one class only, every score is the share of toxic labels, or zero without any.
Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from civicloom.llm.common import held_out, labelled_sample, text_of
from civicloom.session import stage_table

BITS = 20
#: The bounded sample that the labels' word counts are taken from, by the smallest hash of the id.
MAX_TRAINING_ROWS = 20_000
#: The prior's weight as a share of the rarer class's, standard errors of the bound, its floor, the drift, the largest E.
PRIOR_SHARE, BOUND, LEAST, DRIFT, MOST_E = 0.05, 2.0, -2.0, 0.5, 0.1
#: Bytes of a word's stems.
STEMS = (4, 5, 6)
THRESHOLD = 0.3
_MASK = (1 << BITS) - 1
#: ASCII letters lower-cased, other ASCII to spaces; bytes of other characters stay.
_LETTERS = bytes(
    c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_KNOWN_WORDS = 300_000
#: Texts whose words are counted at a time.
TOGETHER = 64
EULER = 0.5772156649


class Model(NamedTuple):
    scores: np.ndarray
    rate: float  # lambda
    log_k: float
    slope: float
    base: float


class Tokens(dict):
    """Texts as rows of bins, one row per word: the word and its stems. Remembers words it has met, by number."""

    def __init__(self) -> None:
        super().__init__()
        self.rows = np.empty((1024, 1 + len(STEMS)), dtype=np.int32)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        if number == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        stems = [zlib.crc32(word[:n], n) if len(word) > n else zlib.crc32(word) for n in STEMS]
        self.rows[number] = [h & _MASK for h in (zlib.crc32(word), *stems)]
        return number

    def __call__(self, text: str) -> np.ndarray:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        words = text.encode().translate(_LETTERS).split()
        numbers = np.array(list(map(self.__getitem__, words)), dtype=np.int64)
        return self.rows[numbers]  # only now, as new words may have made the table grow


def word_scores(bins: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """A score for each word, its own or the best of its stems."""
    return scores[bins].max(axis=1, initial=LEAST)


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """Every maximal scoring segment, ``(score, start, end)``, in linear time.

    Only tokens above zero can start or end one, so the scan steps over those and takes
    what lies between from running sums.
    """
    starts = np.flatnonzero(scores > 0)
    if not len(starts):
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    # Sum before, sum after, start, end, and the place of the last earlier segment that starts lower.
    stack: list[tuple[float, float, int, int, int]] = []
    for start, before, after in zip(starts.tolist(), sums[starts].tolist(), sums[starts + 1].tolist()):
        end, k = start + 1, len(stack) - 1
        # Those that start no lower can't be joined, nor can any between them and the one they name.
        while k >= 0 and stack[k][0] >= before:
            k = stack[k][4]
        while k >= 0 and stack[k][1] < after:
            before, start, lower = stack[k][0], stack[k][2], stack[k][4]
            del stack[k:]
            k = lower
        stack.append((before, after, start, end, k))
    return [(after - before, start, end) for before, after, start, end, _ in stack]


def found_passages(bins: np.ndarray, scores: np.ndarray) -> list[tuple[float, int, int]]:
    """Every maximal scoring segment with its damped score: within it a word that is said again adds nothing.

    The scan sees all words in full, so single ones elsewhere in the text take nothing from a passage. Where
    repeats have stretched a segment, its best part without them counts.
    """
    own = word_scores(bins, scores)
    high = np.flatnonzero(own > 0)
    at, words = high.tolist(), bins[high, 0].tolist()
    found, i = [], 0
    for score, a, b in segments(own):
        i = bisect_left(at, a, i)
        j = bisect_left(at, b, i)
        if len(set(words[i:j])) < j - i:
            part = own[a:b].copy()
            said: set[int] = set()
            for k in range(i, j):
                if words[k] in said:
                    part[at[k] - a] = 0.0
                said.add(words[k])
            score = max(segments(part))[0]
        found.append((score, a, b))
        i = j
    return found


def token_scores(toxic: np.ndarray, other: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Lower confidence bound of each token's log-odds, less the drift.

    ``toxic`` and ``other`` count the texts that hold a token, so one text that repeats a
    word says it once. A token met in few texts has a wide bound and no positive score.
    """
    weight = max(PRIOR_SHARE * min(toxic.sum(), other.sum()), 1.0)
    prior = weight * (corpus + 1e-3) / (corpus + 1e-3).sum()
    a, b = toxic + prior, other + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    return np.maximum(odds - BOUND * np.sqrt(1 / a + 1 / b), LEAST) - DRIFT


def growth_rate(scores: np.ndarray, corpus: np.ndarray) -> float:
    """The positive lambda at which the mean of exp(lambda score) over the corpus is one."""
    shares = (corpus + 1e-9) / (corpus + 1e-9).sum()
    low, high = 1e-4, 20.0
    for _ in range(80):
        middle = (low + high) / 2
        if shares @ np.exp(np.minimum(middle * scores, 600)) > 1:
            high = middle
        else:
            low = middle
    return low


def statistic(bins: np.ndarray, model: Model) -> float:
    """The sum of -ln E over segments that chance would give fewer than ``MOST_E`` of."""
    chance = model.log_k + np.log(max(len(bins), 1))
    evidence = [model.rate * s - chance for s, _, _ in found_passages(bins, model.scores)]
    return float(sum(e for e in evidence if e > -np.log(MOST_E)))


def _logistic(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -40, 40))))


def _curve(x: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and base of a logistic curve by Newton steps, with a weak pull to zero."""
    design, at = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -40, 40)))
        step = np.linalg.solve(
            (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2), design.T @ (label - p) - 1e-3 * at
        )
        at = at + np.clip(step, -2, 2)
    return float(max(at[0], 0)), float(at[1])


def _scored(bins: list[np.ndarray], label: np.ndarray, corpus: np.ndarray) -> Model:
    counts = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for b, x in zip(bins, label):
        counts[int(x)][np.unique(b)] += 1
    scores = token_scores(counts[1], counts[0], corpus)
    return Model(scores, growth_rate(scores, corpus), 0.0, 0.0, 0.0)


def fit(rows: list[tuple[str, int]], corpus: np.ndarray) -> Model:
    """Token scores from all rows; K and the curve from halves scored by each other's words."""
    label = np.array([x for _, x in rows], dtype=float)
    if not len(rows) or label.min() == label.max():
        base = 40.0 if len(rows) and label[0] else -40.0
        return Model(np.full(1 << BITS, -DRIFT), 1.0, 0.0, 0.0, base)
    tokens = Tokens()
    bins = [tokens(text) for text, _ in rows]
    halves = [range(0, len(rows), 2), range(1, len(rows), 2)]
    found = [(_scored([bins[i] for i in mine], label[list(mine)], corpus), other) for mine, other in (halves, halves[::-1])]
    most = []
    for m, other in found:
        for i in other:
            if not label[i] and (own := found_passages(bins[i], m.scores)):
                most.append(m.rate * max(own)[0] - np.log(len(bins[i])))
    log_k = float(np.mean(most)) - EULER if most else 0.0
    pairs = [(np.log1p(statistic(bins[i], m._replace(log_k=log_k))), label[i]) for m, other in found for i in other]
    slope, base = _curve(*map(np.array, zip(*pairs)))
    return _scored(bins, label, corpus)._replace(log_k=log_k, slope=slope, base=base)


def word_counts(docs: DataFrame) -> DataFrame:
    """``bin, n``: tokens per bin over all documents, at most ``2 ** BITS`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = Tokens(), np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i in range(0, len(texts), TOGETHER):
                bins = np.concatenate([tokens(text).ravel() for text in texts[i : i + TOGETHER]])
                met, n = np.unique(bins, return_counts=True)
                counts[met] += n
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[met], pa.int64())], ["bin", "n"])

    rows = docs.select(text_of().alias("text")).mapInArrow(run, "bin int, n bigint")
    return rows.groupBy("bin").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Word counts of all documents and the bounded sample meet in one task; both are of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, rows = np.zeros(1 << BITS), []
        for b in batches:
            counted = b.filter(b.column("bin").is_valid())
            corpus[counted.column("bin").to_numpy(zero_copy_only=False)] = counted.column("n").to_numpy(zero_copy_only=False)
            sampled = b.filter(b.column("text").is_valid())
            rows += zip(sampled.column("text").to_pylist(), sampled.column("label").to_pylist())
        model = fit(sorted(rows, key=lambda row: (zlib.crc32(row[0].encode()), row)), corpus)
        columns = [pa.array([model.scores.astype(np.float32).tobytes()], pa.binary()), pa.array([json.dumps(model[1:])])]
        yield pa.RecordBatch.from_arrays(columns, ["scores", "rest"])

    sample = labelled_sample(docs, labels, "toxic", max_rows).select("text", "label")
    # The counts are written first, so that they are summed by many tasks and the fit reads finished ones.
    both = stage_table(word_counts(docs), "token_counts").unionByName(sample, allowMissingColumns=True)
    row = both.coalesce(1).mapInArrow(run, "scores binary, rest string").first()
    if row is None:  # no partition, no task
        return fit([], np.zeros(1 << BITS))
    return Model(np.frombuffer(row["scores"], np.float32), *json.loads(row["rest"]))


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, start, end, evidence``: the token ranges of every significant passage, with -ln E."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, own = Tokens(), Model(*shared.value)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bins = tokens(text)
                chance = own.log_k + np.log(max(len(bins), 1))
                found = [(own.rate * s - chance, a, b) for s, a, b in found_passages(bins, own.scores)]
                rows += [(doc, a, b, float(e)) for e, a, b in found if e > -np.log(MOST_E)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "start", "end", "evidence"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), text_of())
    return rows.mapInArrow(run, "doc_id bigint, start int, end int, evidence double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("double")
    def of(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens, own = Tokens(), Model(*shared.value)
        for texts in frames:
            found = [_logistic(own.slope * np.log1p(statistic(tokens(t), own)) + own.base) for t in texts.tolist()]
            yield pd.Series(found, dtype="float64")

    scored = docs.select("doc_id", of(text_of()).alias("score"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
