"""Writers: full refresh, append-only log, idempotent per-run publish, exports."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from civicloom import schemas
from civicloom.functions.columns import rows_checksum
from civicloom.sources.readers import read_optional


def materialize(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a table name or of a path (anything with a slash)."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def append_gate_log(rows: DataFrame, path: str) -> None:
    """Append gate rows, stamping ``logged_at``; the log is created on first use."""
    stamped = rows.withColumn("logged_at", F.current_timestamp().cast("timestamp_ntz"))
    columns = [F.col(f.name).cast(f.dataType) for f in schemas.GATE_LOG.fields]
    stamped.select(*columns).coalesce(1).write.mode("append").partitionBy("run_id").parquet(path)


def read_gate_log(spark: SparkSession, path: str) -> DataFrame:
    """The log, or an empty frame of its schema when it was never written."""
    if read_optional(spark, path) is None:
        return spark.createDataFrame([], schemas.GATE_LOG)
    return spark.read.schema(schemas.GATE_LOG).parquet(path)


def replace_run(df: DataFrame, path: str, run_id: str, column: str = "run_id") -> None:
    """Publish one run's rows, dropping whatever that run published before.

    Only the run's own partition is overwritten, so doing it twice leaves one copy
    and other runs are untouched. A run that now yields nothing clears its partition.
    """
    spark = df.sparkSession
    run = df.withColumn(column, F.lit(run_id))
    counted = Observation("replace_run")
    (
        run.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    if counted.get["rows"] == 0 and read_optional(spark, path) is not None:
        spark.createDataFrame([], run.schema).drop(column).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{path}/{column}={run_id}")


def export_gold(
    tables: Mapping[str, DataFrame | None],
    directory: str,
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Write each table as ZSTD Parquet; returns a manifest with one row per table.

    Every table must be there before anything is written. Row counts and checksums of the
    contents come from the write itself, so no table is read twice; ``verify_export`` takes both again
    from the files. ``partition_by`` names the folder columns
    of a table; its rows are rebalanced on them first, which gives even files and
    splits a folder that holds most of the rows over several tasks.
    """
    partition_by = partition_by or {}
    absent = sorted(name for name, df in tables.items() if df is None)
    if absent:
        raise ValueError(f"cannot export, missing gold tables: {', '.join(absent)}")
    manifest, spark = [], None
    for name, df in tables.items():
        spark = df.sparkSession
        counted = Observation(f"export_{name}")
        path = f"{directory}/{name}"
        folders = partition_by.get(name, ())
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows"), rows_checksum(df.schema).alias("checksum"))
        if folders:
            rows = rows.hint("rebalance", *folders)
        (
            rows.write.mode("overwrite")
            .partitionBy(*folders)
            .option("compression", "zstd")
            .option("partitionOverwriteMode", "static")
            .parquet(path)
        )
        manifest.append((name, path, counted.get["rows"], counted.get["checksum"], df.schema.json()))
    if spark is None:
        raise ValueError("no table to export")
    return spark.createDataFrame(manifest, "table_name string, path string, row_count bigint, checksum bigint, table_schema string")


def verify_export(manifest: DataFrame) -> DataFrame:
    """The manifest with what its files hold now, one aggregation a table: ``found_rows, found_checksum, verified``.

    A table whose files are gone holds nothing.
    """
    spark, found = manifest.sparkSession, []
    for entry in manifest.collect():  # one row per exported table
        schema = T.StructType.fromJson(json.loads(entry["table_schema"]))
        there = read_optional(spark, entry["path"]) is not None
        rows = spark.read.schema(schema).parquet(entry["path"]) if there else spark.createDataFrame([], schema)
        counts = rows.agg(F.count(F.lit(1)).alias("found_rows"), rows_checksum(schema).alias("found_checksum"))
        found.append(counts.select(F.lit(entry["table_name"]).alias("table_name"), "*"))
    both = manifest.join(reduce(DataFrame.unionByName, found), "table_name")
    same = (F.col("row_count") == F.col("found_rows")) & (F.col("checksum") == F.col("found_checksum"))
    return both.withColumn("verified", same)


def write_sorted(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Write in one total order; the order lives in the files, not in the table."""
    materialize(df.orderBy(*order), path)


def write_findings(df: DataFrame, directory: str) -> None:
    """The same findings as CSV and as JSON lines, each written by the tasks."""
    flat = df.select(
        *[
            F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct") else f.name
            for f in df.schema.fields
        ]
    )
    flat.write.mode("overwrite").option("header", True).csv(f"{directory}/csv")
    df.write.mode("overwrite").json(f"{directory}/json")
