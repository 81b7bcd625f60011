"""Ranked lexical search: Block-Max MaxScore over sharded, block-compressed posting lists.

Each task turns the documents it reads into shards, one row each: posting lists cut into
compressed blocks, and for every block the pairs of term count and document length that
may score highest in it, so that block maxima are exact under statistics that are only
known once all shards are written. A search broadcasts items in blocks of bounded size.
In a shard, lists whose bounds add up to no more than the lowest score that counts are
non-essential: only the others are gone through, and a candidate that they yield is
dropped by the block maxima of the non-essential lists before any of those blocks is
decompressed. Shards don't meet: the best of each go into one ranking at the end.

Terms are runs of letters, digits and characters beyond ASCII; only A-Z are lower-cased.

Defined results. Null or empty text has no term: such a document is in no shard, such an
item has no row. Equal scores go to the smaller ``doc_id``, null last; a null id is a
document like others. Repeated rows are documents of their own and count each; rows that
repeat an ``item_id`` are one item with the terms of all. Extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from civicloom.llm.common import ascii_lower, text_of
from civicloom.session import stage_table

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
#: A shard ends at so many documents or postings, a posting block at so many documents.
SHARD_DOCS, SHARD_POSTINGS, BLOCK = 1 << 16, 1 << 22, 128
#: Documents of a shard that are scored at a time.
WINDOW = 1 << 12
#: Index terms are restricted to those asked for, and items broadcast, up to so many bytes; more items go in further rounds.
TERM_BYTES, ITEM_BYTES, ROW_BYTES = 1 << 25, 1 << 24, 32
CACHED_BLOCKS, MERGE_PARTS = 1 << 14, 64
_LETTERS = bytes(
    c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
_WIDTHS = (np.dtype("<u1"), np.dtype("<u2"), np.dtype("<u4"))
INDEX = (
    "n_docs bigint, n_terms bigint, ids binary, unnamed int, lengths binary, terms array<binary>, found array<bigint>, "
    "blocks binary, last binary, impact_ends binary, impact_tf binary, impact_n binary, packed_ends binary, packed binary"
)
_KINDS = [
    pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), *[pa.binary()] * 7,
]
_NAMES = [part.split()[0] for part in INDEX.split(", ")]


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


class Numbers(dict):
    """Numbers terms as they come."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _width(values: np.ndarray) -> int:
    top = int(values.max())
    return 0 if top < 1 << 8 else 1 if top < 1 << 16 else 2


def pack(places: np.ndarray, tf: np.ndarray) -> bytes:
    """A block: widths, the first place, the gaps after it, the term counts."""
    gaps = np.diff(places)
    a, b = _width(gaps) if len(gaps) else 0, _width(tf)
    return bytes((a, b)) + int(places[0]).to_bytes(4, "little") + gaps.astype(_WIDTHS[a]).tobytes() + tf.astype(_WIDTHS[b]).tobytes()


def unpack(packed: bytes, count: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = _WIDTHS[packed[0]], _WIDTHS[packed[1]]
    places = np.empty(count, dtype=np.int64)
    places[0] = int.from_bytes(packed[2:6], "little")
    places[1:] = np.frombuffer(packed, a, count - 1, 6)
    return np.cumsum(places), np.frombuffer(packed, b, count, 6 + (count - 1) * a.itemsize).astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places of the pairs that no other pair of at least the count and at most the length outdoes."""
    order = np.lexsort((-tf, n))
    high = np.maximum.accumulate(tf[order])
    return order[np.concatenate(([True], high[1:] > high[:-1]))]


class Gathered:
    """Documents and their postings until they are written as a shard."""

    def __init__(self, known: dict[bytes, int] | None) -> None:
        self.known = known
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers() if self.known is None else self.known
        self.ids: list[int | None] = []
        self.lengths, self.sizes, self.terms, self.tf = (array("q") for _ in range(4))

    def add(self, doc: int | None, text: bytes) -> None:
        words = terms_of(text)
        if not words:
            return
        found = Counter(map(self.numbers.__getitem__ if self.known is None else self.numbers.get, words))
        found.pop(None, None)
        self.ids.append(doc)
        self.lengths.append(len(words))
        self.sizes.append(len(found))
        self.terms.extend(found.keys())
        self.tf.extend(found.values())

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or len(self.terms) >= SHARD_POSTINGS

    def shard(self) -> tuple:
        """Documents in the order of their ids, lists in blocks."""
        by_id = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        place = np.empty(len(by_id), dtype=np.int64)
        place[by_id] = np.arange(len(by_id))
        lengths = np.asarray(self.lengths, dtype=np.int64)[by_id]
        named = [self.ids[i] for i in by_id if self.ids[i] is not None]
        terms, tf = np.asarray(self.terms, dtype=np.int64), np.asarray(self.tf, dtype=np.int64)
        places = np.repeat(place, np.asarray(self.sizes, dtype=np.int64))
        order = np.lexsort((places, terms))
        terms, tf, places = terms[order], tf[order], places[order]
        n = lengths[places]
        names = {number: term for term, number in self.numbers.items()}
        numbers, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        blocks, last, kept, kept_ends, packed, packed_ends, size = [], [], [], [], [], [], 0
        for start, end in zip(starts.tolist(), ends.tolist()):
            blocks.append(-(-(end - start) // BLOCK))
            for a in range(start, end, BLOCK):
                b = min(a + BLOCK, end)
                last.append(int(places[b - 1]))
                kept.append(a + impacts(tf[a:b], n[a:b]))
                kept_ends.append(len(kept[-1]))
                packed.append(pack(places[a:b], tf[a:b]))
                size += len(packed[-1])
                packed_ends.append(size)
        best = np.concatenate(kept) if kept else np.empty(0, dtype=np.int64)

        def raw(values, kind: str = "<i8") -> bytes:
            return np.asarray(values, dtype=kind).tobytes()

        return (
            len(by_id), int(lengths.sum()), raw(named), len(by_id) - len(named), raw(lengths), [names[i] for i in numbers.tolist()],
            (ends - starts).tolist(), raw(blocks), raw(last), raw(np.cumsum(kept_ends)), raw(tf[best]), raw(n[best]), raw(packed_ends),
            b"".join(packed),
        )


def build_index(docs: DataFrame, wanted: list[bytes] | None = None) -> DataFrame:
    """The shards of all documents, written; with ``wanted`` they hold the lists of those terms only."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if shared.value is None else {term: i for i, term in enumerate(shared.value)}
        own = Gathered(known)

        def batch() -> pa.RecordBatch:
            columns = [pa.array([v], kind) for v, kind in zip(own.shard(), _KINDS)]
            own.clear()
            return pa.RecordBatch.from_arrays(columns, _NAMES)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own.add(doc, text)
                if own.full():
                    yield batch()
        if own.ids:
            yield batch()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().cast("binary").alias("text"))
    return stage_table(rows.mapInArrow(run, INDEX), "lexical_index")


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's score in a document before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Shard:
    def __init__(self, row: dict, docs: int, terms: int) -> None:
        def of(name: str) -> np.ndarray:
            return np.frombuffer(row[name], dtype="<i8")

        def m(n: np.ndarray) -> np.ndarray:
            return 100 - 50 + (50 * n * docs) // terms

        self.ids, self.size, self.m = of("ids"), row["n_docs"], m(of("lengths"))
        self.number = {term: i for i, term in enumerate(row["terms"])}
        self.found, blocks = row["found"], of("blocks")
        self.first = np.concatenate(([0], np.cumsum(blocks)))
        self.last, self.ends, self.packed = of("last"), of("packed_ends"), row["packed"]
        best = parts(of("impact_tf"), m(of("impact_n")))
        starts = np.concatenate(([0], of("impact_ends")[:-1]))
        self.block_max = np.maximum.reduceat(best, starts) if len(best) else best
        self.list_max = np.maximum.reduceat(self.block_max, self.first[:-1]) if len(best) else best
        self.cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.decompressed = 0

    def block(self, t: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and parts of one block of list ``t``."""
        if (held := self.cache.get(k)) is not None:
            return held
        if len(self.cache) >= CACHED_BLOCKS:
            self.cache.clear()
        self.decompressed += 1
        count = min(BLOCK, self.found[t] - BLOCK * (k - int(self.first[t])))
        places, tf = unpack(self.packed[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])], count)
        held = self.cache[k] = places, parts(tf, self.m[places])
        return held

    def between(self, t: int, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and parts of list ``t`` from ``start`` to ``stop``."""
        a, b = int(self.first[t]), int(self.first[t + 1])
        low, high = a + np.searchsorted(self.last[a:b], (start, stop - 1))
        held = [self.block(t, k) for k in range(int(low), min(int(high) + 1, b))]
        if not held:
            return self.last[:0], self.last[:0]
        places, part = (np.concatenate(x) for x in zip(*held))
        i, j = np.searchsorted(places, (start, stop))
        return places[i:j], part[i:j]

    def blocks_at(self, t: int, places: np.ndarray) -> np.ndarray:
        """The block of list ``t`` that would hold each place; one past its last for none."""
        a, b = int(self.first[t]), int(self.first[t + 1])
        return a + np.searchsorted(self.last[a:b], places)

    def best(self, item: list[tuple[bytes, int]], top: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and places of the ``top`` documents scoring above ``floor``, equal scores by place."""
        lists = sorted((w * int(self.list_max[t]), w, t) for term, w in item if (t := self.number.get(term)) is not None)
        bounds = np.cumsum([bound for bound, _, _ in lists], dtype=np.int64)
        scores, where, least = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), floor
        for start in range(0, self.size, WINDOW):
            # Lists before this one can't lift a document above ``least`` even together.
            essential = int(np.searchsorted(bounds, least, side="right"))
            if essential == len(lists):
                break
            stop = min(start + WINDOW, self.size)
            sums = np.zeros(stop - start, dtype=np.int64)
            for _, w, t in lists[essential:]:
                places, part = self.between(t, start, stop)
                sums[places - start] += w * part
            near = np.flatnonzero(sums)
            own = sums[near]
            if essential and len(near):
                at = [self.blocks_at(t, start + near) for _, _, t in lists[:essential]]
                most = np.cumsum([
                    np.where(k < self.first[t + 1], w * self.block_max[np.minimum(k, len(self.block_max) - 1)], 0)
                    for k, (_, w, t) in zip(at, lists)
                ], axis=0)
                for j in range(essential - 1, -1, -1):
                    stays = own + most[j] > least
                    near, own, most, at = near[stays], own[stays], most[:, stays], [k[stays] for k in at[: j + 1]]
                    if not len(near):
                        break
                    _, w, t = lists[j]
                    own = own + w * self._parts_at(t, at[j], start + near)
            keep = own > least
            scores, where = np.concatenate((scores, own[keep])), np.concatenate((where, start + near[keep]))
            if len(scores) > top:
                order = np.lexsort((where, -scores))[:top]
                scores, where = scores[order], where[order]
            if len(scores) == top:
                least = max(floor, int(scores.min()))
        return scores, where

    def _parts_at(self, t: int, blocks: np.ndarray, places: np.ndarray) -> np.ndarray:
        found = np.zeros(len(places), dtype=np.int64)
        inside = blocks < self.first[t + 1]
        for k in np.unique(blocks[inside]).tolist():
            mine = np.flatnonzero(blocks == k)
            held, part = self.block(t, k)
            i = np.minimum(np.searchsorted(held, places[mine]), len(held) - 1)
            found[mine] = np.where(held[i] == places[mine], part[i], 0)
        return found


class Ranking:
    """An item's best of all shards that a task has searched; a null id is a flag that orders last."""

    def __init__(self, top: int) -> None:
        self.top, self.rows = top, np.empty((0, 3), dtype=np.int64)  # score, unnamed, id

    def floor(self) -> int:
        """Scores up to this can't enter. Equal to the last one they can, by a smaller id."""
        return int(self.rows[-1, 0]) - 1 if len(self.rows) == self.top else 0

    def add(self, scores: np.ndarray, where: np.ndarray, ids: np.ndarray) -> None:
        unnamed = where >= len(ids)
        own = np.where(unnamed, 0, ids[np.minimum(where, len(ids) - 1)] if len(ids) else 0)
        rows = np.concatenate((self.rows, np.column_stack((scores, unnamed, own))))
        self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[: self.top]]


def query_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``: each item's terms once."""
    found = F.array_distinct(F.regexp_extract_all(ascii_lower(text_of()), F.lit(TERM), F.lit(0)))
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.explode(found).alias("term"))
    return rows.select("item_id", F.col("term").cast("binary").alias("term")).distinct()


def _searched(index: DataFrame, asked: list[tuple], docs: int, terms: int, top: int) -> DataFrame:
    """``item_id, doc_id, score, part``: each task's best for items of bounded size, ``(item_id, term, weight)``."""
    shared = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: dict[int | None, list[tuple[bytes, int]]] = {}
        for item, term, w in shared.value:
            items.setdefault(item, []).append((bytes(term), w))
        rankings = {item: Ranking(top) for item in items}
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, docs, terms)
                for item, asked_terms in items.items():
                    rankings[item].add(*shard.best(asked_terms, top, rankings[item].floor()), shard.ids)
        part = TaskContext.get().partitionId() % MERGE_PARTS
        for item, ranking in rankings.items():
            score, unnamed, own = ranking.rows.T
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(own), pa.int64()), pa.array(own, mask=unnamed.astype(bool)), pa.array(score), pa.array([part] * len(own), pa.int32())],
                ["item_id", "doc_id", "score", "part"],
            )

    return index.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint, part int")


def _ranked(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search(index: DataFrame, asked: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best documents of each item in ``asked``, ``item_id, term``."""
    sums = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    docs, terms = sums["docs"] or 0, sums["terms"] or 0
    found = index.select(F.explode(F.arrays_zip("terms", "found")).alias("x"))
    df = found.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.found").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = asked.join(df, "term").select("item_id", "term", weight.alias("weight")).filter("weight > 0")
    weighted = stage_table(weighted, "item_weights")
    size = weighted.agg(F.sum(F.length("term") + ROW_BYTES)).first()[0] or 0
    rounds = -(-size // ITEM_BYTES)
    of_round = F.pmod(F.xxhash64("item_id"), F.lit(max(rounds, 1)))
    results = []
    for i in range(rounds):
        rows = [tuple(r) for r in weighted.filter(of_round == i).select("item_id", "term", "weight").collect()]
        results.append(_searched(index, rows, docs, terms, top))
    if not results:
        return asked.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    # The best of each task are merged in parts before an item's rows meet.
    merged = _ranked(reduce(DataFrame.unionByName, results), ["item_id", "part"], top).drop("rank")
    return _ranked(merged, ["item_id"], top).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item by score."""
    asked = stage_table(query_terms(items), "item_terms")
    wanted = asked.select("term").distinct()
    size = wanted.agg(F.sum(F.length("term") + ROW_BYTES)).first()[0] or 0
    # Beyond the bound the index holds every term, and needs no broadcast.
    known = [bytes(r[0]) for r in wanted.collect()] if size <= TERM_BYTES else None
    return search(build_index(docs, known), asked, top)
