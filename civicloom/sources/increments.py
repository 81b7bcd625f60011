"""High-watermark ingest: pull what is newer than the saved mark, then move the mark."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from civicloom import rules
from civicloom.sources.readers import read_optional

_STATE = "last_created_date string, updated_at timestamp_ntz"


def read_mark(spark: SparkSession, state_path: str, default: str = rules.FIRST_MARK) -> str:
    """The mark saved last. Marks are only ever appended, so a crash cannot lose one.

    They are text, so the newest is told by when it was saved, not by its letters.
    """
    try:
        state = spark.read.schema(_STATE).json(state_path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return default
        raise
    return state.agg(F.max_by("last_created_date", "updated_at")).first()[0] or default


def write_mark(spark: SparkSession, state_path: str, mark: str) -> None:
    spark.range(1).select(
        F.lit(mark).alias("last_created_date"),
        F.current_timestamp().cast("timestamp_ntz").alias("updated_at"),
    ).write.mode("append").json(state_path)


def increment(df: DataFrame, ts_col: str, mark: str) -> DataFrame:
    """Rows strictly newer than the mark; the filter reaches the source's scan."""
    return df.filter(F.col(ts_col) > F.lit(mark).cast(df.schema[ts_col].dataType))


def late_rows(df: DataFrame, ts_col: str, mark: str) -> DataFrame:
    """Rows at or before the mark, which an increment never sees: ingested before, or late."""
    return df.filter(F.col(ts_col) <= F.lit(mark).cast(df.schema[ts_col].dataType))


def untimed_rows(df: DataFrame, ts_col: str) -> DataFrame:
    """Rows without a time. With ``increment`` and ``late_rows`` they make up the whole."""
    return df.filter(F.col(ts_col).isNull())


def left_behind(df: DataFrame, ts_col: str, mark: str, known: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows an increment passes over for good, with a ``reason``: ``late``, or ``no_time``.

    A row at or before the mark is late if ``known``, what was ingested so far, has none
    of its keys. NULL keys match NULL keys.
    """
    old = late_rows(df, ts_col, mark).withColumn("reason", F.lit("late"))
    missed = old.unionByName(untimed_rows(df, ts_col).withColumn("reason", F.lit("no_time")))
    if known is None:
        return missed
    seen = known.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_seen_{k}")) for k in keys]
    return missed.join(seen, same, "left_anti")


def ingest_increment(
    df: DataFrame,
    state_path: str,
    ts_col: str,
    target: str,
    default_mark: str = rules.FIRST_MARK,
    quarantine: str | None = None,
    keys: Sequence[str] = (),
) -> dict[str, object]:
    """Append the increment to ``target`` and advance the mark to the newest row in it.

    The rows land in a partition named after the mark they started from, and the
    mark moves only after they are committed: a crash in between makes the next
    run overwrite that same partition, never duplicate it.

    With a ``quarantine`` path, rows that the increment passes over and that neither
    table holds by ``keys`` are written there before the mark moves, in a partition
    named the same way.
    """
    spark = df.sparkSession
    mark = read_mark(spark, state_path, default_mark)
    folder = re.sub(r"[^0-9]", "", mark)
    held = 0
    if quarantine:
        held = _quarantine(df, ts_col, mark, target, quarantine, keys, folder)
    seen = Observation("increment")
    (
        increment(df, ts_col, mark)
        .observe(seen, F.count(F.lit(1)).alias("rows"), F.max(ts_col).cast("string").alias("newest"))
        .withColumn("ingest_mark", F.lit(folder))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_mark")
        .parquet(target)
    )
    newest = seen.get["newest"]
    if newest is not None:
        write_mark(spark, state_path, newest)
    return {"rows": seen.get["rows"], "from_mark": mark, "to_mark": newest or mark, "held": held}


def _quarantine(
    df: DataFrame, ts_col: str, mark: str, target: str, quarantine: str, keys: Sequence[str], folder: str
) -> int:
    """Writes what is left behind and not held yet; returns how many rows."""
    spark = df.sparkSession
    known = None
    for path in (target, quarantine):
        table = read_optional(spark, path)
        if table is not None:
            # The run's own partition is about to be overwritten, so it is not known.
            table = table.filter(F.col("ingest_mark").cast("string") != folder).select(*keys)
            known = table if known is None else known.unionByName(table)
    counted = Observation("quarantine")
    (
        left_behind(df, ts_col, mark, known, keys)
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .withColumn("ingest_mark", F.lit(folder))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_mark")
        .parquet(quarantine)
    )
    return counted.get["rows"]
