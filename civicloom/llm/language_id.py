"""Language identification by prediction with partial matching.

Each language has a tree of byte contexts of up to three bytes with counts from its
training texts, frozen afterwards. A byte's probability in a context is its share there
or, if it was never seen there, the context's escape probability (method C) times its
probability in the next shorter context, down to equal shares of all 256 bytes. The exact
code length of a text is the sum over its bytes; the language with the shortest one wins,
and the score is its posterior under equal priors.

A tree is sparse: contexts of two and three bytes are hash tables of what the language's own sample
holds, so it doesn't depend on how many or which other languages there are. Trees are
trained one language a group and stored as a table; texts are scored against blocks of
trees of bounded size, one block after the other.

The sample is bounded: ``MAX_ROWS`` rows of a language by the smallest hash of the id, of which
each gives an equal part of ``MAX_BYTES``, what short rows leave going to longer ones. Of a row that is
longer than its part, slices spread evenly over the text are taken.

Defined results. Null text, or text without a letter, or no learned language: ``und``
with score zero. Null languages and null ids teach nothing, nor do languages without a byte. Ties go to the
first name. Repeated rows are scored each. Extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.llm.common import held_out
from civicloom.session import stage_table

UNKNOWN = "und"
ORDER = 3
MAX_ROWS, MAX_BYTES = 400, 1_000_000
#: A row is cut to so many bytes before its language's rows meet; slices of a row that is cut.
ROW_BYTES, SLICES = 1 << 18, 8
SALTS = 64
#: Trees are held by a task in blocks of so many bytes, and of one tree at least.
BLOCK_BYTES = 1 << 27
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes of a text that are looked up at a time, and of short texts together.
_CHUNK, TOGETHER = 1 << 18, 1 << 16
_SPREAD, _AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_EMPTY = np.uint32(0xFFFFFFFF)


class Table(NamedTuple):
    """Keys with their bits: slots by two hashes, one after the other, and what found neither place, sorted."""

    slots: tuple[np.ndarray, np.ndarray]
    values: tuple[np.ndarray, np.ndarray]
    rest: np.ndarray
    rest_values: np.ndarray


def _slot(keys: np.ndarray, size: int, again: bool) -> np.ndarray:
    shift = np.uint64(64 - (size.bit_length() - 1))
    return ((keys.astype(np.uint64) + np.uint64(1)) * (_AGAIN if again else _SPREAD)) >> shift


def table_of(keys: np.ndarray, bits: np.ndarray) -> Table:
    """A table of sorted keys. One that looks like an empty slot, if any, is the last and goes to the rest."""
    slots, values, left = [], [], np.arange(len(keys) - (len(keys) > 0 and keys[-1] == _EMPTY))
    for again in (False, True):
        size = 1 << max(int(1.25 * len(left)).bit_length(), 4)
        at = _slot(keys[left], size, again).astype(np.int64)
        first = np.unique(at, return_index=True)[1]
        own, held = np.full(size, _EMPTY, dtype=np.uint32), np.zeros(size, dtype=np.float32)
        own[at[first]], held[at[first]] = keys[left[first]], bits[left[first]]
        slots.append(own)
        values.append(held)
        left = np.delete(left, first)
    left = np.append(left, np.arange(len(keys))[keys == _EMPTY])
    return Table(tuple(slots), tuple(values), keys[left], bits[left].astype(np.float32))


def look_up(table: Table, keys: np.ndarray) -> np.ndarray:
    """Bits by key; NaN where there are none."""
    found = np.full(len(keys), np.nan, dtype=np.float32)
    left = np.arange(len(keys))
    for again in (False, True):
        wanted = keys[left]
        at = _slot(wanted, len(table.slots[again]), again).astype(np.int64)
        hit = (table.slots[again][at] == wanted) & (wanted != _EMPTY)
        found[left[hit]] = table.values[again][at[hit]]
        left = left[~hit]
    if len(table.rest) and len(left):
        i = np.minimum(np.searchsorted(table.rest, keys[left]), len(table.rest) - 1)
        hit = table.rest[i] == keys[left]
        found[left[hit]] = table.rest_values[i[hit]]
    return found


class Tree(NamedTuple):
    one: np.ndarray  # bits of a byte after a byte, by both
    two_escape: np.ndarray  # by two bytes
    two: Table  # bits of a byte after two, by all three
    three_escape: Table  # by three bytes
    three: Table  # bits of a byte after three, by all four


def _grams(text: bytes) -> np.ndarray:
    """Each byte with the three before it as one number; three spaces stand before the text."""
    s = np.frombuffer((b" " * ORDER + text).translate(_LOWER), np.uint8).astype(np.uint32)
    return (s[:-3] << 24) | (s[1:-2] << 16) | (s[2:-1] << 8) | s[3:]


def _sparse(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and bits of what follows a context, and contexts with the bits of their escape."""
    keys, n = np.unique(grams, return_counts=True)
    contexts, first, kinds = np.unique(keys >> np.uint32(8), return_index=True, return_counts=True)
    total = np.add.reduceat(n, first) + kinds
    own = -np.log2(n / np.repeat(total, kinds))
    return keys, own, contexts, -np.log2(kinds / total)


def _dense(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    seen, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    with np.errstate(divide="ignore"):
        own = -np.log2(counts / np.maximum(seen + kinds, 1))
        escape = np.where(seen > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(seen + kinds, 1)), 0.0)
    return np.where(counts > 0, own, escape + shorter)


def fit(text: bytes) -> Tree:
    """The frozen tree of a language's training bytes, of which there is at least one."""
    grams = _grams(text)
    none = _dense(np.bincount(grams & 0xFF, minlength=256)[None, :], np.full((1, 256), 8.0))
    one = _dense(np.bincount(grams & 0xFFFF, minlength=1 << 16).reshape(256, 256), np.repeat(none, 256, axis=0))
    two_keys, two, contexts, escapes = _sparse(grams & np.uint32(0xFFFFFF))
    two_escape = np.zeros(1 << 16, dtype=np.float32)
    two_escape[contexts] = escapes
    three_keys, three, contexts, escapes = _sparse(grams)
    return Tree(
        one.ravel().astype(np.float32), two_escape, table_of(two_keys, two), table_of(contexts, escapes), table_of(three_keys, three)
    )


def _bits(grams: np.ndarray, tree: Tree) -> np.ndarray:
    """Bits of each gram's last byte after the three before it."""
    found = look_up(tree.three, grams)
    left = np.flatnonzero(np.isnan(found))
    escape = look_up(tree.three_escape, grams[left] >> np.uint32(8))
    shorter = grams[left] & np.uint32(0xFFFFFF)
    less = look_up(tree.two, shorter)
    last = np.isnan(less)
    less[last] = tree.two_escape[shorter[last] >> np.uint32(8)] + tree.one[shorter[last] & np.uint32(0xFFFF)]
    found[left] = np.nan_to_num(escape) + less
    return found


def code_length(text: bytes, tree: Tree) -> float:
    """Bits of the text in the language."""
    total = 0.0
    for i in range(0, len(text), _CHUNK):
        before = text[max(i - ORDER, 0) : i]
        total += float(_bits(_grams(before + text[i : i + _CHUNK])[len(before) :], tree).sum(dtype=np.float64))
    return total


def code_lengths(texts: list[bytes], trees: list[Tree]) -> np.ndarray:
    """Bits by tree and text, of texts that are not empty; short texts go through the tables together."""
    if len(texts) == 1:
        return np.array([[code_length(texts[0], tree)] for tree in trees])
    grams = _grams((b" " * ORDER).join(texts))
    sizes = np.array([len(t) for t in texts])
    starts = np.concatenate(([0], np.cumsum(sizes[:-1] + ORDER)))
    between = (starts[1:, None] - ORDER + np.arange(ORDER)).ravel()
    result = np.empty((len(trees), len(texts)))
    for row, tree in zip(result, trees):
        bits = _bits(grams, tree).astype(np.float64)
        bits[between] = 0.0
        row[:] = np.add.reduceat(bits, starts)
    return result


def packed(tree: Tree) -> tuple[bytes, int]:
    """The tree to be stored, and its size in memory."""
    held = io.BytesIO()
    arrays = [tree.one, tree.two_escape]
    for table in tree[2:]:
        arrays += [*table.slots, *table.values, table.rest, table.rest_values]
    np.savez_compressed(held, *arrays)
    return held.getvalue(), sum(a.nbytes for a in arrays)


def unpacked(data: bytes) -> Tree:
    with np.load(io.BytesIO(data)) as found:
        arrays = [found[name] for name in found.files]
    tables = [Table(tuple(a[:2]), tuple(a[2:4]), a[4], a[5]) for a in (arrays[i : i + 6] for i in range(2, len(arrays), 6))]
    return Tree(arrays[0], arrays[1], *tables)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Best(NamedTuple):
    """The shortest code so far, and the sum of all languages' likelihoods relative to its."""

    language: str = UNKNOWN
    bits: float = float("inf")
    sum: float = 0.0


def _likelihood(bits: np.ndarray | float, best: np.ndarray | float) -> np.ndarray:
    return np.exp2(np.maximum(np.subtract(best, bits), -1000.0))


def best_of(texts: list[str | None], trees: dict[str, Tree], before: list[Best] | None = None) -> list[Best]:
    """Each text's best of the trees and of what was best before, in the order of their names."""
    result, names = list(before or [Best()] * len(texts)), sorted(trees)
    group: list[tuple[int, bytes]] = []

    def judge() -> None:
        bits = code_lengths([t for _, t in group], [trees[name] for name in names])
        first = bits.argmin(axis=0)
        least = bits[first, np.arange(len(group))]
        sums = _likelihood(bits, least).sum(axis=0)
        for (i, _), k, b, total in zip(group, first.tolist(), least.tolist(), sums.tolist()):
            old = result[i]
            if old.bits <= b:
                result[i] = old._replace(sum=old.sum + total * float(_likelihood(b, old.bits)))
            else:
                result[i] = Best(names[k], b, total + (old.sum * float(_likelihood(old.bits, b)) if old.sum else 0.0))
        group.clear()

    size = 0
    for i, text in enumerate(texts):
        if names and has_letter(text):
            group.append((i, text.encode()))
            size += len(group[-1][1])
            if size >= TOGETHER:
                judge()
                size = 0
    if group:
        judge()
    return result


def predict(text: str | None, trees: dict[str, Tree]) -> tuple[str, float]:
    best = best_of([text], trees)[0]
    return best.language, 1 / best.sum if best.sum else 0.0


def spread(text: bytes, size: int) -> bytes:
    """The text, or slices of it spread evenly, of ``size`` bytes in all."""
    if len(text) <= size:
        return text
    count = min(SLICES, max(size // 64, 1))
    part, step = size // count, len(text) // count
    return b"".join(text[i * step : i * step + part] for i in range(count))


def joined(texts: list[bytes], size: int) -> bytes:
    """All texts within ``size`` bytes: an equal part each, what short ones leave going to the others."""
    order, left, taken = sorted(range(len(texts)), key=lambda i: len(texts[i])), size, {}
    for k, i in enumerate(order):
        taken[i] = spread(texts[i], left // (len(order) - k))
        left -= len(taken[i])
    return b"\n".join(taken[i] for i in range(len(texts)) if taken[i])


def _sample(docs: DataFrame) -> DataFrame:
    """``lang, order, text``: the bounded sample of each language, texts as bytes and cut to ``ROW_BYTES``."""
    rows = docs.select(F.col("doc_id"), F.col("lang").cast("string").alias("lang"), "text").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    )
    # Ids are ranked without their texts. The rank limit runs before each shuffle, and a language is first ranked in
    # parts, so that what many tasks send for a common one doesn't meet in one task.
    order = F.xxhash64("doc_id")
    first = Window.partitionBy("lang").orderBy(order, "doc_id")
    few = Window.partitionBy("lang", F.pmod(order, F.lit(SALTS))).orderBy(order, "doc_id")
    ids = rows.select("doc_id", "lang").withColumn("place", F.row_number().over(few)).filter(F.col("place") <= MAX_ROWS)
    ids = ids.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= MAX_ROWS)
    # As many ids as languages, so the optimizer chooses the join by their size.
    chosen = rows.join(stage_table(ids.select("doc_id", "lang").distinct(), "sampled_ids"), ["doc_id", "lang"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [spread(t, ROW_BYTES) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.binary())], ["lang", "order", "doc_id", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    short = chosen.select("lang", order.alias("order"), "doc_id", F.col("text").cast("binary").alias("text"))
    short = short.mapInArrow(cut, f"lang string, order bigint, doc_id {kinds['doc_id']}, text binary")
    return short.groupBy("lang", "order", "doc_id").agg(F.max("text").alias("text")).select("lang", "order", "text")


def train(docs: DataFrame) -> DataFrame:
    """``lang, tree, block``: each language's tree, fitted in a task of its own on its bounded sample, and written."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("order").to_pylist(), table.column("text").to_pylist()))
        text = joined([t for _, t in rows], MAX_BYTES)
        names = [table.column("lang")[0].as_py()] if text else []
        trees, sizes = zip(packed(fit(text))) if text else ((), ())
        columns = pa.array(names, pa.string()), pa.array(trees, pa.binary()), pa.array(sizes, pa.int64())
        return pa.table(dict(zip(("lang", "tree", "size"), columns)))

    trees = stage_table(_sample(docs).groupBy("lang").applyInArrow(run, "lang string, tree binary, size bigint"), "language_trees")
    before = Window.orderBy("lang").rowsBetween(Window.unboundedPreceding, -1)  # one number a language
    block = F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / BLOCK_BYTES)
    return trees.select("lang", "tree").join(trees.select("lang", block.alias("block")), "lang")


def _scored(rows: DataFrame, block: DataFrame, text: Column, before: Column | None) -> DataFrame:
    """``rows`` with ``found``, the best of the languages in the block and those before it."""
    # The driver holds the packed trees of one block.
    trees = {r["lang"]: bytes(r["tree"]) for r in block.select("lang", "tree").collect()}
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("language string, bits double, sum double")
    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = {name: unpacked(tree) for name, tree in shared.value.items()}
        for frame in frames:
            texts = frame["text"].tolist()
            olds = None if "language" not in frame else [Best(*b) for b in zip(frame["language"], frame["bits"], frame["sum"])]
            yield pd.DataFrame(best_of(texts, own, olds), columns=["language", "bits", "sum"])

    given = [text.alias("text")] if before is None else [text.alias("text"), *[before[c].alias(c) for c in ("language", "bits", "sum")]]
    return rows.withColumn("found", of(F.struct(*given)))


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    trees = stage_table(train(docs), "language_blocks")
    blocks = [r["block"] for r in trees.groupBy("block").agg(F.count(F.lit(1))).orderBy("block").collect()]
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    if not blocks:
        nothing = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score")]
        return rows.select("doc_id", "held_out", *nothing)
    rows = _scored(rows, trees.filter(F.col("block") == blocks[0]), F.col("text"), None)
    for block in blocks[1:]:  # one pass over the texts for each further block of trees
        rows = _scored(stage_table(rows, "scored_languages"), trees.filter(F.col("block") == block), F.col("text"), F.col("found"))
    score = F.when(F.col("found.sum") > 0, 1 / F.col("found.sum")).otherwise(0.0)
    return rows.select("doc_id", "held_out", F.col("found.language").alias("lang_pred"), score.alias("score"))
