"""Exact order statistics by repeated counting.

A global ``percentile`` keeps every distinct value in one reducer. Here each pass
counts the values per bin with ordinary partial aggregation, so what travels is at
most ``BINS`` rows per open interval, and the next pass looks only inside the bin
that holds the wanted rank. The bounds of a bin are values that occur in it, so
the search ends exactly on one value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.session import stage_table

BINS = 4096


def numeric_value(column: Column) -> Column:
    """The column as a double, NaN as NULL."""
    value = column.cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


@dataclass(frozen=True)
class Bounds:
    """Number, smallest and largest of a column's values; NULL and NaN are not values."""

    count: int
    low: float | None
    high: float | None


def column_bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, Bounds]:
    """Bounds of several columns from one scan."""
    if not columns:
        return {}
    measures = {"n": F.count, "low": F.min, "high": F.max}
    row = df.agg(
        *[
            f(numeric_value(F.col(f"`{c}`"))).alias(f"{name}{i}")
            for i, c in enumerate(columns)
            for name, f in measures.items()
        ]
    ).first()
    return {c: Bounds(*[row[f"{name}{i}"] for name in measures]) for i, c in enumerate(columns)}


@dataclass(frozen=True)
class _Interval:
    """Values of one column in [low, high]; ``below`` counts the values under it."""

    column: str
    low: float
    high: float
    below: int


def _squash(value: Column) -> Column:
    """A monotone map that brings far outliers close, so that bins are not wasted on them."""
    return F.signum(value) * F.log1p(F.abs(value))


def _squash_number(value: float) -> float:
    return math.copysign(math.log1p(abs(value)), value)


def _bin(value: Column, interval: _Interval) -> Column:
    """Bin number; it never decreases as the value grows."""
    if not (math.isfinite(interval.low) and math.isfinite(interval.high)):
        # Infinities get the outermost bins to themselves; finite doubles squash into +-710.
        place = F.floor((_squash(value) + 710.0) / 1420.0 * (BINS - 2)) + 1
        return (
            F.when(value == math.inf, BINS - 1).when(value == -math.inf, 0).otherwise(place).cast("int")
        )
    wide = interval.high - interval.low
    if math.isfinite(wide) and (interval.low == 0 or wide <= 1e3 * abs(interval.low)):
        low, span, mapped = interval.low, wide, value
    else:
        low, mapped = _squash_number(interval.low), _squash(value)
        span = _squash_number(interval.high) - low
    if span <= 0:
        return F.lit(0)
    place = F.floor((mapped - F.lit(low)) / F.lit(span) * F.lit(float(BINS)))
    return F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)).cast("int")


def _hits(df: DataFrame, intervals: Sequence[_Interval]) -> DataFrame:
    """``interval, bin, v``: every value with each interval it lies in, by the interval's place.

    The range test is on the bare column, so that a scan can skip what lies outside. Values become
    rows by an expansion of plain columns, which Spark compiles; an array of structs per row costs several times as much.
    """
    inside = [F.col(f"`{i.column}`").between(F.lit(i.low), F.lit(i.high)) for i in intervals]
    names = list(map(str, range(len(intervals))))
    values = df.filter(reduce(lambda a, b: a | b, inside)).select(
        *[F.when(hit, F.col(f"`{i.column}`").cast("double")).alias(name) for hit, i, name in zip(inside, intervals, names)]
    )
    hits = values.unpivot([], names, "interval", "v").filter("v IS NOT NULL")
    places = [(F.col("interval") == name, _bin(F.col("v"), i)) for name, i in zip(names, intervals)]
    place = reduce(lambda chain, p: chain.when(*p), places[1:], F.when(*places[0]))
    return hits.select("interval", place.alias("bin"), "v")


def _narrow(
    df: DataFrame, wanted: dict[_Interval, set[int]]
) -> dict[_Interval, dict[int, _Interval]]:
    """One pass over the data: where inside each interval does each rank lie?"""
    intervals = list(wanted)
    bins = (
        _hits(df, intervals)
        .groupBy(F.col("interval").cast("int").alias("interval"), "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .collect()  # at most BINS rows per interval
    )
    found: dict[_Interval, dict[int, _Interval]] = {interval: {} for interval in intervals}
    below = {i: interval.below for i, interval in enumerate(intervals)}
    for row in sorted(bins, key=lambda b: (b.interval, b.bin)):
        interval = intervals[row.interval]
        start = below[row.interval]
        for rank in wanted[interval]:
            if start <= rank < start + row.n:
                found[interval][rank] = _Interval(interval.column, row.low, row.high, start)
        below[row.interval] = start + row.n
    return found


def values_at_ranks(
    df: DataFrame, bounds: dict[str, Bounds], ranks: dict[str, set[int]]
) -> dict[tuple[str, int], float]:
    """The value at each zero-based ascending rank of each column."""
    open_ranks = {
        (c, rank): _Interval(c, bounds[c].low, bounds[c].high, 0)
        for c, wanted in ranks.items()
        for rank in wanted
    }
    values: dict[tuple[str, int], float] = {}
    while open_ranks:
        settled = {key: iv.low for key, iv in open_ranks.items() if iv.low == iv.high}
        values.update(settled)
        open_ranks = {key: iv for key, iv in open_ranks.items() if key not in settled}
        wanted: dict[_Interval, set[int]] = {}
        for (_, rank), interval in open_ranks.items():
            wanted.setdefault(interval, set()).add(rank)
        if wanted:
            found = _narrow(df, wanted)
            open_ranks = {(c, rank): found[iv][rank] for (c, rank), iv in open_ranks.items()}
    return values


def exact_quantiles(
    df: DataFrame, bounds: dict[str, Bounds], probabilities: Sequence[float]
) -> dict[tuple[str, float], float]:
    """Quantiles with linear interpolation between neighbours.

    Columns without values are left out of the result.
    """
    position = {
        (c, p): (b.count - 1) * p for c, b in bounds.items() if b.count > 0 for p in probabilities
    }
    ranks: dict[str, set[int]] = {}
    for (c, _), place in position.items():
        ranks.setdefault(c, set()).update((math.floor(place), math.ceil(place)))
    values = values_at_ranks(df, bounds, ranks)
    result = {}
    for (c, p), place in position.items():
        low, high = values[c, math.floor(place)], values[c, math.ceil(place)]
        result[c, p] = low + (high - low) * (place - math.floor(place))
    return result


#: First bins per unit of squashed value; a key can have at most 1,420 units. Then bins within one key's middle bin.
GROUP_BINS, REFINED_BINS = 64, 1024
#: A middle bin of at most so many different values is put in order; a fuller one is cut again.
MIDDLE_CELLS = 4096
#: Parts that a key's values are joined in.
JOIN_PARTS = 32


def _holds(rank: str, size: str) -> Column:
    """Whether a bin (or value) of that size, ``below`` values under it, holds the rank."""
    return (F.col("below") <= F.col(rank)) & (F.col(rank) < F.col("below") + F.col(size))


def _middles(bins: DataFrame) -> DataFrame:
    """``key, first, last, below, low, high, cells, lower, upper``: where each key's middle ranks lie.

    ``bins`` has ``key, bin, size, cells, low, high, before, first, last``. Middle ranks in two bins, or in one that
    holds a single value, are settled by the bins' bounds: ``lower`` and ``upper`` then hold the
    values. Otherwise one bin holds both.
    """
    order = Window.partitionBy("key").orderBy("bin")
    placed = bins.withColumn("below", F.col("before") + F.sum("size").over(order) - F.col("size"))
    entry = F.struct("bin", "below", "low", "high", "cells")
    found = placed.groupBy("key").agg(
        F.max("first").alias("first"), F.max("last").alias("last"),
        F.max(F.when(_holds("first", "size"), entry)).alias("a"), F.max(F.when(_holds("last", "size"), entry)).alias("b"),
    )
    settled = (F.col("a.bin") != F.col("b.bin")) | (F.col("a.low") == F.col("a.high"))
    return found.select(
        "key", "first", "last", "a.below", "a.low", "a.high", "a.cells",
        F.when(settled, F.col("a.high")).alias("lower"), F.when(settled, F.col("b.low")).alias("upper"),
    )


def _cells_within(cells: DataFrame, middle: DataFrame) -> DataFrame:
    """The counted values of each key that lie in its middle bin, with the bin's columns.

    A hot key's values are joined in parts, so that no task gets all of them.
    """
    its = middle.withColumnRenamed("key", "its_key").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(JOIN_PARTS - 1))))
    parted = cells.filter("v IS NOT NULL").withColumn("its_part", F.pmod(F.xxhash64("v"), F.lit(JOIN_PARTS)).cast("int"))
    same = F.col("key").eqNullSafe(F.col("its_key")) & (F.col("its_part") == F.col("part"))
    inside = F.col("v").between(F.col("low"), F.col("high"))
    return parted.join(its, same & inside).drop("its_key", "part", "its_part")


def _refined(cells: DataFrame, middle: DataFrame) -> DataFrame:
    """The middle bins cut again, each between its own bounds."""
    # Halves keep the width of any two finite doubles finite.
    v, low, high = (_finite(F.col(c)) / 2 for c in ("v", "low", "high"))
    place = (v - low) / (high - low)
    cut = F.least(F.floor(place * REFINED_BINS), F.lit(REFINED_BINS - 1))
    inside = _cells_within(cells, middle).withColumn("bin", cut)
    return inside.groupBy("key", "bin").agg(
        F.sum("n").alias("size"), F.count(F.lit(1)).alias("cells"), F.min("v").alias("low"), F.max("v").alias("high"),
        F.max("below").alias("before"), F.max("first").alias("first"), F.max("last").alias("last"),
    )


def middle_bins(cells: DataFrame, first_bins: DataFrame) -> DataFrame:
    """``_middles`` of every key, bins cut until each is settled or holds at most ``MIDDLE_CELLS`` values.

    Each round is a count per key and bin, and only looks inside the bins still too full.
    """
    parts, found = [], stage_table(_middles(first_bins), "middle_bins")
    full = F.col("lower").isNull() & (F.col("cells") > MIDDLE_CELLS)
    while not found.filter(full).isEmpty():
        parts.append(found.filter(~full))
        found = stage_table(_middles(_refined(cells, found.filter(full))), "middle_bins")
    return reduce(DataFrame.unionByName, [*parts, found])


def grouped_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, count, mean, median, min, max) per group, the median exact.

    Equal values are counted first and stored. A key's values are then counted per bin of a
    monotone scale and the bins (not the values) put in order. A middle bin that is still
    full is cut again, by its own bounds, until it holds few different values; only those are ordered
    among themselves. So no key has its values sorted in one task, however many
    it has and however close they are. Rows of a NULL key are one group.
    """
    cells = stage_table(
        df.select(F.col(key).alias("key"), numeric_value(F.col(value)).alias("v")).groupBy("key", "v").agg(F.count(F.lit(1)).alias("n")),
        "group_cells",
    )
    real = F.col("v").isNotNull()
    bins = cells.groupBy("key", F.floor(_squash(_finite(F.col("v"))) * GROUP_BINS).alias("bin")).agg(
        F.sum(F.when(real, F.col("n")).otherwise(0)).alias("size"), F.count("v").alias("cells"),
        F.sum(F.col("v") * F.col("n")).alias("total"), F.min("v").alias("low"), F.max("v").alias("high"),
    )
    bins = stage_table(bins, "group_bins")
    whole = bins.groupBy("key").agg(
        F.sum("size").alias("count"), F.sum("total").alias("total"), F.min("low").alias("min"), F.max("high").alias("max")
    )
    half = (F.sum("size").over(Window.partitionBy("key")) - 1) / 2.0
    first = bins.filter("bin IS NOT NULL").withColumns({"first": F.floor(half), "last": F.ceil(half), "before": F.lit(0).cast("bigint")})
    middle = stage_table(middle_bins(cells, first), "group_middles")
    inside = _cells_within(cells, middle.filter("lower IS NULL"))
    inside = inside.withColumn("below", F.col("below") + F.sum("n").over(Window.partitionBy("key").orderBy("v")) - F.col("n"))
    ordered = inside.groupBy("key").agg(
        F.max(F.when(_holds("first", "n"), F.col("v"))).alias("lower"), F.max(F.when(_holds("last", "n"), F.col("v"))).alias("upper")
    )
    settled = middle.filter("lower IS NOT NULL").select("key", "lower", "upper").unionByName(ordered)
    median = settled.select(F.col("key").alias("its_key"), ((F.col("lower") + F.col("upper")) / 2).alias("median"))
    return whole.join(median, F.col("key").eqNullSafe(F.col("its_key")), "left").select(
        F.col("key").alias(key), "count", (F.col("total") / F.nullif(F.col("count"), F.lit(0))).alias("mean"), "median", "min", "max"
    )


def _finite(value: Column) -> Column:
    """Infinities as the largest doubles, so that every value has a bin."""
    top = 1.7976931348623157e308
    return F.when(value > top, top).when(value < -top, -top).otherwise(value)
