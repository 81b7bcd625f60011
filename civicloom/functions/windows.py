"""Keyed selection and ranking that hold up when one key owns most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.session import stage_table


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    tie_breakers: Sequence[Column] = (),
) -> DataFrame:
    """One row per key, the first under ``order`` then ``tie_breakers``.

    The rank filter lets Spark put a group limit in front of the shuffle: each map
    task sends at most one row per key, so a key with a third of all rows costs
    its reducer one row per map task, not the whole group.
    """
    spec = Window.partitionBy(*keys).orderBy(*order, *tie_breakers)
    return df.withColumn("_rank", F.row_number().over(spec)).filter("_rank = 1").drop("_rank")


def top_value(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent ``value`` per key; equal counts go to the smaller value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("value_count"))
    return keep_latest(counts, keys, [F.desc("value_count"), F.col(value).asc_nulls_last()])


def with_time_index(df: DataFrame, group: str, order: str, name: str = "t") -> DataFrame:
    """1..N within each group. Rows per group are calendar steps, so groups stay small."""
    spec = Window.partitionBy(group).orderBy(order)
    return df.withColumn(name, F.row_number().over(spec).cast("bigint"))


def global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Exact global ``row_number`` without a single-task window.

    A range-partitioned sort puts the rows in order; the id Spark gives each row
    then holds its partition and its position in it. The sorted rows are written
    once so that the ids cannot change, the partition sizes (one row per shuffle
    partition) are turned into offsets, and rank = offset + position.
    """
    ordered = stage_table(
        df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id()), "ranked"
    )
    part = F.shiftright("_row", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    position = F.col("_row") - F.shiftleft(F.col("_part"), 33)
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + 1)
        .drop("_row", "_part", "_offset")
    )
