"""License scan by ordered signature rules.

A text becomes its words joined by single spaces. A keyword prefilter picks the rules whose
gating words all occur; only their patterns are matched. Overlapping detections are
resolved by containment: one that lies inside another of higher priority is dropped, and
of equal priority inside a longer one, or an earlier rule's of the same extent. What is left
are the text's licenses; the fixed base phrases are looked up besides and always stay.

Defined results. Null or empty text has no word and no license. A null id is an id like
others; repeated rows are scanned each. Only A-Z are lower-cased; digits and characters
beyond ASCII belong to words. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from civicloom.llm.common import text_of
from civicloom.llm.license_rules import Rule, compiled

#: Fixed phrases and their labels.
BASE = {b"gnu general public license": "gpl", b"apache license": "apache", b"cc by": "cc-by", b"mit license": "mit"}
_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_FOUND = [("label", pa.string()), ("rule", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("priority", pa.int32()), ("confidence", pa.float64())]
_PLACE = [("label", pa.string()), ("start", pa.int64())]
SCHEMA = (
    "doc_id bigint, n_words bigint, base array<struct<label:string,start:bigint>>, "
    "detections array<struct<label:string,rule:int,start:bigint,end:bigint,priority:int,confidence:double>>"
)


class Detection(NamedTuple):
    label: str
    rule: int
    start: int  # of its words
    end: int
    priority: int
    confidence: float


def resolved(found: list[Detection]) -> list[Detection]:
    """Detections that no other one contains with more right, by place."""
    kept: list[Detection] = []
    starts: list[int] = []
    reach: list[int] = []
    for level in sorted({d.priority for d in found}, reverse=True):
        own, far = [], -1
        # Longer ones come first at a place, so a contained one comes after what contains it.
        for d in sorted((d for d in found if d.priority == level), key=lambda d: (d.start, -d.end, d.rule)):
            above = bisect_right(starts, d.start)
            if d.end > far and not (above and reach[above - 1] >= d.end):
                own.append(d)
            far = max(far, d.end)
        kept = sorted(kept + own, key=lambda d: (d.start, d.end, d.rule))
        starts, reach = [d.start for d in kept], np.maximum.accumulate([d.end for d in kept]).tolist()
    return kept


class Scanner:
    def __init__(self, rules: list[Rule] | None = None) -> None:
        self.rules = compiled() if rules is None else rules
        self.base = [(frozenset(phrase.split()), b" %b " % phrase, label) for phrase, label in BASE.items()]
        self.gates = frozenset().union(*(r.words for r in self.rules), *(words for words, _, _ in self.base))

    def __call__(self, text: bytes) -> tuple[int, list[tuple[str, int]], list[Detection]]:
        """Number of words, places of the base phrases, detections."""
        words = text.translate(_WORDS).split()
        met = self.gates.intersection(words)
        tried = [r for r in self.rules if r.words <= met]
        phrases = [(phrase, label) for gate, phrase, label in self.base if gate <= met]
        if not tried and not phrases:
            return len(words), [], []
        line = b" %b " % b" ".join(words)
        spaces = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)

        def word(at: int) -> int:
            """The number of the word after the space at ``at``."""
            return int(np.searchsorted(spaces, at))

        base = []
        for phrase, label in phrases:
            at = line.find(phrase)
            while at >= 0:
                base.append((label, word(at)))
                at = line.find(phrase, at + 1)
        found = [
            Detection(r.label, r.number, word(m.start()), word(m.end()), r.priority, r.confidence)
            for r in tried for m in r.pattern.finditer(line)
        ]
        return len(words), sorted(base, key=lambda x: (x[1], x[0])), resolved(found)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, base, detections`` of every row; words are counted from 0, ``end`` is behind the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            sizes, base, found = zip(*map(scanner, batch.column(1).to_pylist())) if len(batch) else ((), (), ())
            columns = [
                batch.column(0), pa.array(sizes, pa.int64()),
                pa.array([[dict(zip(("label", "start"), p)) for p in row] for row in base], pa.list_(pa.struct(_PLACE))),
                pa.array([[d._asdict() for d in row] for row in found], pa.list_(pa.struct(_FOUND))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "base", "detections"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().cast("binary").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def report(docs: DataFrame) -> DataFrame:
    """Per row: words, base phrases with their first and last place, labels, and the surest detection's confidence."""
    rows = scan(docs)
    starts, base, labels = F.col("base.start"), F.col("base.label"), F.col("detections.label")
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _joined(base).alias("base_labels"), _joined(F.concat(base, labels)).alias("labels"),
        F.coalesce(F.array_max("detections.confidence"), F.lit(0.0)).alias("score"),
    )
