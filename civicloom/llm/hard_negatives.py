"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

Rows are dealt to shards and anchors to blocks, and each block meets each shard. In a
shard every dimension has its candidates sorted by value. An anchor goes down all lists at
once, from the top where its own component is not negative, else from the bottom; each row
it comes upon is scored at random access as an integer inner product. What the lists'
current values would add up to bounds all rows not yet come upon: the search of a window
of scores stops once that bound is strictly below the window's last wanted score, or below
the window itself. A first search finds each anchor's positives, one window without
limits among rows of its label; a second one the negatives of each positive's window.

Defined results. Rows with a null id, label, vector or component, with a non-finite
component or one beyond ``LARGEST`` (scores stay within 64 bits), with no component, or
of another length than most take no part. Equal scores go to the smaller ``vec_id``, then to
the row stored first. Repeated rows are rows of their own: each is an anchor, and can be
the other's positive. An anchor without positives, and a positive without negatives in its
window, have no row. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.llm.lists import by_group
from civicloom.session import stage_table

SCALE, LARGEST = 256, float(1 << 18)
POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of its positive's.
LEAST_SHARE, MOST_SHARE = 50, 95
SHARD_ROWS, BLOCK_ANCHORS = 8192, 1024
#: Steps down the lists before the bound is first looked at; they double.
STEP = 16
_EXACT = float(1 << 53)
_FOUND = ["anchor", "window", "vec_id", "node", "score"]


class Lists:
    """A shard's candidates, and each dimension's sorted by value."""

    def __init__(self, x: np.ndarray, ids: np.ndarray) -> None:
        self.x, self.ids = x, ids
        self.order = np.argsort(x, axis=0, kind="stable").T
        self.value = np.take_along_axis(x.T, self.order, axis=1)
        self.accessed = 0

    def search(
        self, anchor: np.ndarray, allowed: np.ndarray, lows: np.ndarray, highs: np.ndarray, top: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and scores of the best ``top`` allowed rows with ``low <= score <= high``, for each window."""
        size, down = len(self.ids), anchor >= 0
        best = [(np.empty(0, dtype=np.int64), np.empty(0)) for _ in lows]
        seen, depth, step = np.zeros(size, dtype=bool), 0, STEP
        while depth < size:
            to = min(depth + step, size)
            met = seen.copy()
            met[self.order[down, size - to : size - depth]] = True
            met[self.order[~down, depth:to]] = True
            new = np.flatnonzero(met & ~seen)
            seen, depth, step = met, to, 2 * step
            new = new[allowed[new]]
            self.accessed += len(new)
            scores = self.x[new] @ anchor
            for i, (low, high) in enumerate(zip(lows, highs)):
                inside = (scores >= low) & (scores <= high)
                if inside.any():
                    places, own = np.concatenate((best[i][0], new[inside])), np.concatenate((best[i][1], scores[inside]))
                    kept = np.lexsort((places, self.ids[places], -own))[:top]
                    best[i] = places[kept], own[kept]
            bound = anchor[down] @ self.value[down, size - depth] + anchor[~down] @ self.value[~down, depth - 1]
            if all(bound < low or len(own) == top and bound < own[-1] for low, (_, own) in zip(lows, best)):
                break
        return best


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.int64).reshape(len(column), -1)


def _searched(table: pa.Table) -> tuple[np.ndarray, ...]:
    """What each anchor of a group finds among the group's candidates, as ``_FOUND``."""
    table = table.sort_by([("node", "ascending"), ("is_anchor", "ascending")])
    role = table.column("is_anchor").to_numpy()
    rows, anchors = (table.filter(pa.array(role == r)).combine_chunks() for r in (False, True))
    if not len(rows) or not len(anchors):
        return tuple(np.empty(0, dtype=np.int64) for _ in _FOUND)
    x, a = (_matrix(t.column("x").combine_chunks()) for t in (rows, anchors))
    # Integers up to 2^53 are exact as doubles, whose products are much faster.
    if float(np.abs(x).max()) * float(np.abs(a).max()) * x.shape[1] < _EXACT:
        x, a = x.astype(np.float64), a.astype(np.float64)
    nodes, labels = (rows.column(k).to_numpy() for k in ("node", "label"))
    lists = Lists(x, rows.column("vec_id").to_numpy())
    found = []
    sides = (anchors.column(k).to_pylist() for k in ("node", "label", "same", "top", "lows", "highs"))
    for anchor, node, label, same, top, lows, highs in zip(a, *sides):
        allowed = (labels == label) & (nodes != node) if same else labels != label
        for i, (places, scores) in enumerate(lists.search(anchor, allowed, np.array(lows), np.array(highs), top)):
            k = len(places)
            found.append((np.full(k, node), np.full(k, i), lists.ids[places], nodes[places], scores.astype(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*found))


def _met(rows: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """``anchor, window, vec_id, node, score`` of all groups; both sides have ``keys``."""
    columns = list(dict.fromkeys([*keys, "node", "vec_id", "label", "x"]))
    both = rows.select(*columns, F.lit(False).alias("is_anchor")).unionByName(
        anchors.select(*columns, F.lit(True).alias("is_anchor"), "same", "top", "lows", "highs"), allowMissingColumns=True
    )
    return by_group(both, keys, _searched, ", ".join(f"{name} bigint" for name in _FOUND))


def _first(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "node")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _split(total: Column, most: int) -> Column:
    return F.ceil(total / most).cast("bigint")


def _every(count: Column) -> Column:
    """All numbers below ``count``, one a row."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1))


def _hundredth(x: Column) -> Column:
    """A whole number divided by 100, rounded down."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100).cast("bigint"))


def usable(embeddings: DataFrame) -> DataFrame:
    """``node, vec_id, label, x`` of the rows that take part; ``x`` is the vector in whole numbers."""

    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST)

    embedding = F.col("embedding")
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), embedding.cast("array<double>").alias("embedding")
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & embedding.isNotNull() & (F.size("embedding") > 0))
    rows = rows.filter(F.forall(embedding, fine))
    rows = rows.withColumn("x", F.transform(embedding, lambda x: F.floor(SCALE * x).cast("int"))).drop("embedding")
    # Written once, so the numbers stay.
    rows = stage_table(rows.withColumn("node", F.monotonically_increasing_id()), "anchored_vectors")
    usual = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.filter(F.size("x") == (usual[0]["n"] if usual else 0))


def positives(rows: DataFrame, is_anchor: Column, top: int = POSITIVES) -> DataFrame:
    """``anchor, vec_id, node, score, rank``: each anchor's best other rows of its label."""
    sizes = rows.groupBy("label").agg(
        _split(F.count(F.lit(1)), SHARD_ROWS).alias("shards"), _split(F.count_if(is_anchor), BLOCK_ANCHORS).alias("blocks")
    )
    dealt = rows.join(sizes.filter("blocks > 0"), "label")
    place = F.xxhash64("node")
    shards = dealt.withColumn("shard", F.pmod(place, F.col("shards"))).withColumn("block", _every(F.col("blocks")))
    anchors = dealt.filter(is_anchor).withColumn("block", F.pmod(place, F.col("blocks"))).withColumn("shard", _every(F.col("shards")))
    limits = {"same": F.lit(True), "top": F.lit(top), "lows": F.array(F.lit(-(1 << 62))), "highs": F.array(F.lit(1 << 62))}
    found = _met(shards, anchors.withColumns(limits), ["label", "shard", "block"])
    return _first(found, ["anchor"], top)


def hard_negatives(
    embeddings: DataFrame, is_anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
    least: int = LEAST_SHARE, most: int = MOST_SHARE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``. A negative is a row of another label
    whose score is from ``least`` to ``most`` hundredths of the positive's.
    """
    rows = usable(embeddings)
    own = positives(rows, is_anchor, n_positives).select(
        "anchor", (F.col("rank") - 1).cast("bigint").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    own = stage_table(own, "positives")
    # The least whole score that is not below the window, the largest that is not above it.
    low = -_hundredth(-least * F.col("positive_score"))
    window = F.struct("window", low.alias("low"), _hundredth(most * F.col("positive_score")).alias("high"))
    windows = own.groupBy("anchor").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    sides = own.groupBy().agg(_split(F.countDistinct("anchor"), BLOCK_ANCHORS).alias("blocks"))
    sizes = rows.agg(_split(F.count(F.lit(1)), SHARD_ROWS).alias("shards")).first()["shards"]
    blocks = sides.first()["blocks"]
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not blocks:
        return embeddings.sparkSession.createDataFrame([], schema)
    place = F.xxhash64("node")
    anchors = rows.join(windows.withColumnRenamed("anchor", "node"), "node").withColumns({
        "block": F.pmod(place, F.lit(blocks)), "same": F.lit(False), "top": F.lit(n_negatives),
        "lows": F.col("windows.low"), "highs": F.col("windows.high"), "shard": _every(F.lit(sizes)),
    })
    shards = rows.withColumns({"shard": F.pmod(place, F.lit(sizes)), "block": _every(F.lit(blocks))})
    found = _first(_met(shards, anchors, ["shard", "block"]), ["anchor", "window"], n_negatives)
    named = own.join(rows.select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return named.join(found, ["anchor", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
