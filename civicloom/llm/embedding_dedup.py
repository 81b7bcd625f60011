"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by the order of its nearest reference points, the pivots. Vectors
that share ``SHARED`` of their ``NEAREST`` pivots are candidates: the inverted lists are
kept by sets of that many pivots, so being in one list is having that shared-pivot count.
A list's members are verified against each other by exact cosine. Components of the
verified links are then gone through in blocks, member by member, which counts every
link inside a component exactly, also those that no list has shown.

Equal vectors are one class throughout and only count. A list of several pieces is
verified exactly: its pieces meet two at a time. The members of lists above ``LONGEST``
are described anew, by pivots drawn from those members alone, as long as that at least
halves them; a crowd that no pivots part is verified exactly too, at quadratic cost.
Lists of equal members are verified once. Pieces and blocks are dense products of
bounded size; pairs are never rows.

The pivots are a bounded sample: of the vectors with the smallest hashes, those that are
no near neighbours of each other, about twice the square root of the number of vectors.
Where these are too few, nearer ones fill them up. All vectors are indexed.

Defined results. Vectors that are null, zero, hold null or non-finite numbers, or have
another length than most, and rows without an id, link with nothing; without an id the
component is null and ``kept`` false. Repeated rows are vectors of their own. Ties among
pivots go to the first. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from civicloom.llm.graph import components
from civicloom.llm.lists import by_group, lists_once, meeting
from civicloom.session import stage_table

MIN_COSINE = 0.95
NEAREST, SHARED = 6, 2
PIVOT_BITS = (6, 13)  # 64 to 8,192 pivots
MAX_PIVOT_COSINES, SAMPLE_PER_PIVOT = (0.5, 0.8, 0.95), 4
PIECE, BLOCK = 2048, 4096
#: Members of longer lists are described anew.
LONGEST = 16_384


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(values.reshape(len(column), -1)) if len(column) else values.reshape(0, 1)


def _usable() -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    embedding = F.col("embedding")
    return (
        F.col("vec_id").isNotNull() & embedding.isNotNull() & F.forall(embedding, finite)
        & F.exists(embedding, lambda x: x != 0)
    )


def classes(rows: DataFrame) -> DataFrame:
    """``h1, h2, node, first_id, copies, embedding``: one row for each different usable vector."""
    good = rows.filter(_usable())
    usual = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    good = good.filter(F.size("embedding") == (usual[0]["n"] if usual else 0))
    found = good.groupBy("h1", "h2").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
    )
    # Written once, so the numbers stay.
    return stage_table(found.withColumn("node", F.monotonically_increasing_id()), "classes")


def apart(sample: np.ndarray, wanted: int, limits: tuple[float, ...]) -> np.ndarray:
    """Up to ``wanted`` rows, nearer to each other than the first limit only as far as others are too few."""
    chosen, taken = np.empty((wanted, sample.shape[1])), np.zeros(len(sample), dtype=bool)
    for limit in limits:
        for i, row in enumerate(sample):
            n = taken.sum()
            if n == wanted:
                break
            if not taken[i] and (not n or (chosen[:n] @ row).max() < limit):
                chosen[n], taken[i] = row, True
    return chosen[: taken.sum()]


def pivots(vectors: DataFrame, count: int, limits: tuple[float, ...] = MAX_PIVOT_COSINES) -> np.ndarray:
    """The pivots, chosen in a task from a bounded sample; they come to the driver as one block of bytes."""
    wanted = 1 << int(np.clip(round(np.log2(max(2 * np.sqrt(count), 1))), *PIVOT_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = pa.Table.from_batches(batches).sort_by([("h1", "ascending"), ("h2", "ascending")])
        found = apart(_rows(sample), wanted, limits)
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()]), pa.array([found.shape[1]])], ["points", "width"])

    sample = vectors.orderBy("h1", "h2").select("h1", "h2", "embedding").limit(SAMPLE_PER_PIVOT * wanted)
    held = sample.coalesce(1).mapInArrow(run, "points binary, width bigint").first()
    return np.frombuffer(held["points"]).reshape(-1, held["width"])


def described(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    """``list, node``: each vector under every set of ``SHARED`` of its nearest pivots."""
    near, shared = min(NEAREST, len(points)), min(SHARED, len(points))
    sets = np.array(list(combinations(range(near), shared)))
    model = vectors.sparkSession.sparkContext.broadcast(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, rows = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for a in range(0, len(rows), 1024):
                order = np.argsort(-(rows[a : a + 1024] @ model.value.T), axis=1, kind="stable")[:, :near]
                members = np.sort(order[:, sets], axis=2).astype(np.int64)
                keys = np.zeros(members.shape[:2], dtype=np.int64)
                for k in range(shared):
                    keys = (keys << PIVOT_BITS[1]) | members[:, :, k]
                columns = [pa.array(keys.ravel()), pa.array(np.repeat(nodes[a : a + 1024], len(sets)))]
                yield pa.RecordBatch.from_arrays(columns, ["list", "node"])

    return vectors.select("node", "embedding").mapInArrow(run, "list bigint, node bigint")


def _rows(table: pa.Table) -> np.ndarray:
    return _matrix(table.column("embedding").combine_chunks())


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of a pair's two blocks, equal if it is one block."""
    block, low, high = table.column("block").to_numpy(), table.column("low")[0].as_py(), table.column("high")[0].as_py()
    return np.flatnonzero(block == low), np.flatnonzero(block == high)


def _joined(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Members linked across a pair of blocks, each with the smallest it is linked to at first or further hand."""
    table = table.sort_by("node")
    nodes, rows = table.column("node").to_numpy(), _rows(table)
    a, b = _sides(table)
    i, j = np.nonzero(rows[a] @ rows[b].T >= MIN_COSINE)
    i, j = a[i], b[j]
    root = np.arange(len(nodes))
    while True:
        lower = root.copy()
        np.minimum.at(lower, i, root[j])
        np.minimum.at(lower, j, root[i])
        lower = np.minimum(lower, lower[lower])
        if (lower == root).all():
            break
        root = lower
    linked = root < np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def verified(keyed: DataFrame, sizes: DataFrame, vectors: DataFrame) -> DataFrame:
    """Edges ``a, b`` that join the linked members of each list. A long list's blocks all meet."""
    met = meeting(keyed.join(sizes, "list"), F.xxhash64("list", "node"), F.ceil(F.col("n") / PIECE))
    met = met.join(vectors.select("node", "embedding"), "node")
    met = met.select("list", "low", "high", "block", "node", "embedding")
    return stage_table(by_group(met, ["list", "low", "high"], _joined, "a bigint, b bigint"), "joined")


def links(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    """Edges ``a, b`` that join all vectors found linked."""
    keyed = stage_table(described(vectors, points), "pivot_lists")
    found, before = [], None
    while True:
        sizes = lists_once(keyed)
        short, long = sizes.filter(F.col("n") <= LONGEST), sizes.filter(F.col("n") > LONGEST)
        crowd = stage_table(keyed.join(long, "list").select("node").distinct(), "crowd")
        count = crowd.count()
        # Pivots that part a crowd no more leave it to its blocks, all of which meet.
        part = count and (before is None or 2 * count <= before)
        found.append(verified(keyed, short if part else sizes, vectors))
        if not part:
            break
        crowd, before = stage_table(vectors.join(crowd, "node"), "crowd_vectors"), count
        keyed = stage_table(described(crowd, pivots(crowd, count, (1.0,))), "pivot_lists")
    return reduce(DataFrame.unionByName, found)


def _counted(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Links of a block pair's members across it, or within it if it is one block."""
    nodes, copies, rows = table.column("node").to_numpy(), table.column("copies").to_numpy(), _rows(table)
    one = table.column("low")[0].as_py() == table.column("high")[0].as_py()
    a, b = _sides(table)
    count = np.zeros(len(nodes), dtype=np.int64)
    for part in np.array_split(a, max(1, len(a) // 1024)):
        near = rows[part] @ rows[b].T >= MIN_COSINE
        if one:
            near[np.arange(len(part)), part] = False
        count[part] += near @ copies[b]
        if not one:
            count[b] += copies[part] @ near
    return nodes, count


def link_counts(members: DataFrame) -> DataFrame:
    """``node, others``: rows of other classes in the component that the class is linked with.

    ``members`` has ``root, node, copies, embedding``. A component's blocks meet two at a time.
    """
    sizes = stage_table(members.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "component_sizes")
    pairs = meeting(members.join(sizes, "root"), F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))
    pairs = pairs.select("root", "low", "high", "block", "node", "copies", "embedding")
    counted = by_group(pairs, ["root", "low", "high"], _counted, "node bigint, others bigint")
    return counted.groupBy("node").agg(F.sum("others").alias("others"))


def near_duplicates(embeddings: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    rows = embeddings.select("vec_id", "embedding").withColumns(
        {"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")}
    )
    vectors = classes(rows)
    count = vectors.count()
    if count:
        roots = stage_table(components(links(vectors, pivots(vectors, count))), "vector_components")
        members = stage_table(vectors.join(roots, "node"), "members")
        firsts = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
        others = link_counts(members.select("root", "node", "copies", "embedding"))
        linked = members.join(firsts, "root").join(others, "node").select("node", "component_id", "others")
    else:
        linked = vectors.selectExpr("node", "first_id AS component_id", "copies AS others")
    known = vectors.join(linked, "node", "left").select(
        "h1", "h2", F.coalesce("component_id", "first_id").alias("component_id"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    known = stage_table(known, "vector_links")
    # Rows that link with nothing may share their hashes with no class, or have no id.
    own = rows.select("vec_id", "h1", "h2").join(known, ["h1", "h2"], "left")
    has_id = F.col("vec_id").isNotNull()
    component = F.when(has_id, F.coalesce("component_id", "vec_id"))
    return own.select(
        "vec_id", F.when(has_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
