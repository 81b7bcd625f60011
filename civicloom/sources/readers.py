"""Bronze and table readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from civicloom import rules


def read_json_bronze(
    spark: SparkSession, path: str | list[str], schema: T.StructType, lines: bool = False
) -> DataFrame:
    """JSON files, by column name.

    A file is one document, an array of objects or a single object; with ``lines`` it
    holds one object per line, which lets Spark split a large file over many tasks.
    Columns a file lacks come back NULL, columns outside the schema are not read,
    and documents or lines that do not parse are left out; ``malformed_json`` counts them.
    A file that is no ``lines`` file is parsed whole by one task, so it should hold no
    more than a few hundred megabytes.
    """
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED")
    return reader.option("multiLine", not lines).json(path)


def malformed_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, lines: bool = False
) -> DataFrame:
    """``source_file, documents, malformed``: what ``read_json_bronze`` reads and leaves out, by file."""
    marked = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    reader = spark.read.schema(marked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_malformed")
    rows = reader.option("multiLine", not lines).json(path)
    # Spark refuses to read the corrupt record alone, so a column is read with it; no length is below zero.
    first = F.length(F.coalesce(F.col(schema.fieldNames()[0]).cast("string"), F.lit("")))
    bad = F.when(F.col("_malformed").isNotNull() | (first < 0), 1).otherwise(0).cast("bigint")
    return rows.groupBy(F.col("_metadata.file_name").alias("source_file")).agg(
        F.sum(1 - bad).alias("documents"), F.sum(bad).alias("malformed")
    )


def file_name() -> Column:
    return F.col("_metadata.file_name")


def series_of(name: Column, pattern: str = rules.SERIES_FILE_PATTERN) -> Column:
    """Series key held in a file name such as ``UNRATE_20240105.json``."""
    return F.regexp_extract(name, pattern, 1)


def with_series_from_filename(df: DataFrame, pattern: str = rules.SERIES_FILE_PATTERN) -> DataFrame:
    """Add ``series_id`` and the file's name to a frame read straight from files."""
    return df.select(
        "*", file_name().alias("source_file"), series_of(file_name(), pattern).alias("series_id")
    )


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None when nothing is stored there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_tabular(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV (with a header) or Parquet, chosen by suffix. CSV needs a schema."""
    if path.lower().endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV file needs a schema")
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.parquet(path)
