"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HELD_OUT_PART, PARTS = 2, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept out of training: crc32 of the id as text leaves 2 when divided by 4. A null id is not held out."""
    part = F.crc32(F.col(doc_id).cast("string").cast("binary")) % PARTS
    return F.coalesce(part == HELD_OUT_PART, F.lit(False))


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``most`` training rows: labelled 0 or 1, not held out.

    The rows are those whose ids hash lowest, so the choice doesn't depend on order or
    partitions. The ids are chosen from the labels alone, and being bounded they are
    broadcast, so texts aren't shuffled. A null id or label teaches nothing. A document labelled
    twice with one value counts once, one labelled both ways not at all; of rows that
    repeat an id only the largest text is taken.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("high"))
        .filter(F.col("label") == F.col("high"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id", "label")
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("doc_id", "text", "label")
