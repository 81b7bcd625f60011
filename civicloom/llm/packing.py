"""Best-fit packing of token pieces by linear grouping.

A piece's length is an integer of at most ``capacity``, so the whole problem is a
histogram of that many counts, whatever the number of documents. The plan is made from
it: large lengths are split into groups of equal cardinality and rounded up to their
group's largest; configurations of these few sizes are optimised by column generation;
actual lengths take the rounded places; what rounding and flooring left over, then the
small lengths, go where they fit best. The plan says which ranks of a length go to
which run of like sequences; Spark ranks the pieces of each length and looks theirs up.

Defined results. Empty input gives no rows. Pieces are told apart by rank, so rows that
repeat each get a place of their own. Ties in a length are ordered by id, piece and
checksum, so a plan gives the same places again. Extra columns are not carried.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from civicloom.llm.tokens import token_pieces
from civicloom.session import stage_table

CAPACITY = 2048
#: Sizes the configurations are made of.
GROUPS = 200
#: Lengths up to this part of the capacity are small and best-fitted afterwards. The scheme is run with each, and the
#: plan of the fewest sequences taken: with few small pieces the first leaves less open, with many the second.
SMALL = (3, 2)
#: Column generation ends when no configuration is worth more than 1 + GAP: the optimum is then within GAP.
GAP = 0.002
ROUNDS = 12
#: A length with more pieces than this is ranked in several parts.
PART_ROWS = 1000

Run = tuple[list[tuple[int, int]], int]  # [(length, copies)], sequences like this


def grouped(counts: np.ndarray, groups: int) -> list[tuple[int, list[list[int]]]]:
    """Groups of equal cardinality over lengths with counts: ``(rounded size, [[length, count], ...])``."""
    total, found, room = int(counts.sum()), [], 0
    quota = max(1, -(-total // groups))
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            if not room:
                found.append((length, []))
                room = quota
            n = min(left, room)
            found[-1][1].append([length, n])
            left, room = left - n, room - n
    merged: dict[int, list[list[int]]] = {}
    for size, members in found:  # a very common length fills several groups
        merged.setdefault(size, []).extend(members)
    return list(merged.items())


def _best_column(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes that fits: a knapsack by number of items."""
    reach = np.arange(capacity + 1)[None, :] - sizes[:, None]
    fits, at = reach >= 0, np.maximum(reach, 0)
    best, picks = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        gain = np.where(fits, best[at] + values[:, None], -1.0)
        pick = gain.argmax(axis=0)
        top = gain[pick, np.arange(capacity + 1)]
        better = top > best + 1e-12
        if not better.any():
            break
        picks.append(np.where(better, pick, -1))
        best = np.where(better, top, best)
    column, room = np.zeros(len(sizes)), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            column[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(values @ column), column


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole uses of configurations, from the linear program's near optimum rounded down.

    Every step brings in a configuration that lowers the number of sequences, or in a
    tie leaves it; ties go to the first row, and rounds are bounded by the size of the
    basis, whatever the data. Any step's amounts are a right plan, only a longer one.
    """
    basis = np.diag(capacity // sizes).astype(float)
    amounts = demand / basis.diagonal()
    for k in range(ROUNDS * len(sizes)):
        if k % 50 == 0:  # in between the inverse is updated, which is cheaper but gathers error
            inverse = np.linalg.inv(basis)
        amounts = np.maximum(inverse @ demand, 0)
        worth, column = _best_column(sizes, np.maximum(inverse.sum(axis=0), 0), capacity)
        if worth <= 1 + GAP:
            break
        step = inverse @ column
        usable = step > 1e-12
        ratios = np.where(usable, amounts / np.where(usable, step, 1), np.inf)
        leaves = int(ratios.argmin())
        basis[:, leaves] = column
        row = inverse[leaves] / step[leaves]
        inverse -= np.outer(step, row)
        inverse[leaves] = row
    return [(basis[:, j].astype(int), int(amounts[j] + 1e-9)) for j in range(len(sizes)) if amounts[j] + 1e-9 >= 1]


class _Bins:
    """Runs of like sequences by free space."""

    def __init__(self, capacity: int):
        self.capacity, self.by_room, self.rooms = capacity, {}, []

    def add(self, pattern: list[tuple[int, int]], many: int) -> None:
        room = self.capacity - sum(length * copies for length, copies in pattern)
        if room < 0:
            raise ValueError("a pattern is over capacity")
        if not self.by_room.setdefault(room, []) and room not in self.rooms[bisect_left(self.rooms, room) :][:1]:
            insort(self.rooms, room)
        self.by_room[room].append((pattern, many))

    def best_fit(self, length: int, count: int) -> None:
        """Places ``count`` pieces where the least space stays free, in new sequences if nowhere else."""
        while count:
            i = bisect_left(self.rooms, length)
            if i == len(self.rooms):
                pattern, many, room = [], -(-count // (self.capacity // length)), self.capacity
            else:
                room = self.rooms[i]
                pattern, many = self.by_room[room].pop()
                if not self.by_room[room]:
                    del self.by_room[room], self.rooms[i]
            each = min(room // length, count)
            filled = min(many, count // each)
            self.add([*pattern, (length, each)], filled)
            count -= filled * each
            if many > filled and pattern:
                self.add(pattern, many - filled)

    def runs(self) -> list[Run]:
        return [run for room in self.rooms for run in self.by_room[room]]


def _substituted(groups: list[tuple[int, list[list[int]]]], chosen: list[tuple[np.ndarray, int]], bins: _Bins) -> list[list[int]]:
    """Puts actual lengths in the rounded places; returns what has none."""
    stock = [[list(x) for x in members][::-1] for _, members in groups]  # the shortest first in line is popped last
    for column, uses in chosen:
        while uses:
            places = [g for g, n in enumerate(column) for _ in range(n)]
            wanted: dict[int, int] = {g: int(n) for g, n in enumerate(column) if n}
            if any(not stock[g] for g in wanted):
                break
            many = min([uses, *(stock[g][-1][1] // n for g, n in wanted.items())])
            pattern: list[tuple[int, int]] = []
            if many:
                for g, n in wanted.items():
                    length = stock[g][-1][0]
                    pattern.append((length, n))
                    stock[g][-1][1] -= n * many
                    if not stock[g][-1][1]:
                        stock[g].pop()
            else:  # one sequence over the end of a length
                many = 1
                for g in places:
                    if not stock[g]:
                        continue
                    pattern.append((stock[g][-1][0], 1))
                    stock[g][-1][1] -= 1
                    if not stock[g][-1][1]:
                        stock[g].pop()
            bins.add(pattern, many)
            uses -= many
    return [x for members in stock for x in members if x[1]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs of like sequences that hold every piece of the histogram."""
    return min((_plan(counts, capacity, small) for small in SMALL), key=lambda runs: sum(many for _, many in runs))


def _plan(counts: dict[int, int], capacity: int, small_part: int) -> list[Run]:
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        histogram[length] = n
    bins = _Bins(capacity)
    if histogram[capacity]:
        bins.add([(capacity, 1)], int(histogram[capacity]))
        histogram[capacity] = 0
    large = histogram.copy()
    large[: capacity // small_part + 1] = 0
    groups = grouped(large, GROUPS)
    rest: list[list[int]] = []
    if groups:
        sizes = np.array([size for size, _ in groups])
        demand = np.array([sum(n for _, n in members) for _, members in groups], dtype=float)
        rest = _substituted(groups, configurations(sizes, demand, capacity), bins)
    small = [[length, int(histogram[length])] for length in np.flatnonzero(histogram[: capacity // small_part + 1]).tolist()]
    for length, n in sorted(rest + small, reverse=True):
        bins.best_fit(length, n)
    return bins.runs()


def blocks(runs: list[Run]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, copies, offset``, sorted: where the ranks of a length go."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, many in runs:
        offset = 0
        for length, copies in pattern:
            rows.append((length, rank.get(length, 0), sequence, copies, offset))
            rank[length] = rank.get(length, 0) + copies * many
            offset += length * copies
        sequence += many
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def planned(histogram: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """``blocks`` of the plan of ``length, count``, which is at most ``capacity`` rows.

    Made in a task: there Spark holds the linear algebra to the task's own cores.
    """
    names = ["length", "rank", "sequence", "copies", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {k: n for b in batches for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in blocks(plan(counts, capacity)).T.copy()], names)

    found = histogram.coalesce(1).mapInArrow(run, ", ".join(f"{name} bigint" for name in names)).toArrow()
    table = np.column_stack([found.column(name).to_numpy() for name in names]).astype(np.int64)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def ranked(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Adds ``rank``, from 0 within a length. A common length is ranked in parts of bounded size."""
    spark = pieces.sparkSession
    parts = spark.createDataFrame(
        [(length, -(-n // PART_ROWS)) for length, n in sorted(counts.items())], "length bigint, parts int"
    )  # at most ``capacity`` rows
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("parts")).cast("int")
    parted = pieces.join(F.broadcast(parts), "length").withColumn("part", part).drop("parts")
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    )
    return (
        parted.withColumn("own_rank", F.row_number().over(own))
        .join(offsets, ["length", "part"])
        .withColumn("rank", F.col("earlier") + F.col("own_rank") - 1)
        .drop("part", "own_rank", "earlier")
    )


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces with ``sequence_id`` and ``offset``."""
    histogram = stage_table(pieces.groupBy("length").count(), "length_counts")
    counts = {r["length"]: r["count"] for r in histogram.collect()}  # at most ``capacity`` rows
    table = planned(histogram, capacity)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = table[:, 0] * (1 << 48) + table[:, 1]
        for frame in frames:
            rank = frame["rank"].to_numpy()
            row = table[np.searchsorted(keys, frame["length"].to_numpy() * (1 << 48) + rank, side="right") - 1]
            place_in_run = rank - row[:, 1]
            frame["sequence_id"] = row[:, 2] + place_in_run // np.maximum(row[:, 3], 1)
            frame["offset"] = row[:, 4] + place_in_run % np.maximum(row[:, 3], 1) * row[:, 0]
            yield frame.drop(columns="rank")

    ready = ranked(pieces, counts).select(*pieces.columns, "rank")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ready.mapInPandas(place, f"{fields}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """Every document's pieces, and each piece's ``sequence_id`` and ``offset``."""
    return pack_pieces(stage_table(token_pieces(docs, capacity, tokenizer), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of packed pieces that carry their ids. A sequence holds at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
