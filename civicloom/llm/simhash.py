"""Near-duplicates by SimHash, found through segment bit counts.

A fingerprint's 16 four-bit segments are mapped to their bit counts, a point in a small
grid. Flipping a bit moves one coordinate by one, so the Manhattan distance of two
points is a lower bound of the Hamming distance, and points at distance two or less
have a grid cell within one step of both. Each distinct fingerprint is put into its
cell and that cell's neighbours; those that share a cell are verified on their bits.

A cell that many fingerprints share is not paired: its members go on to the exact
fingerprints of that cell within one bit of them. All that meet at one of these are
within two bits of each other, so each is linked with the smallest only, and any two
within two bits meet at one. Both ways lose no link.

Defined results. Null or empty text has fingerprint zero and links like any other. A
null ``doc_id`` is never a component's id unless it has no other. Repeated rows share a
fingerprint. Ties don't arise. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom.llm.common import text_of
from civicloom.llm.graph import components
from civicloom.session import stage_table

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 2
#: Cells with more fingerprints than this take the exact way through shared neighbours.
CELL_PAIRS = 32
SEGMENT, SEGMENTS = 4, 16
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_AT = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str, words_in: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles, as a signed number. ASCII only is lower-cased and split at."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_in, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())],
        dtype="<u8",
    )
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE_AT).ravel(), minlength=2048).reshape(8, 256)
    bits = (seen @ _BYTE_BITS).ravel() * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words_in: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, words_in) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.int64())], ["doc_id", "text_key", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id bigint, text_key bigint, fp bigint"
    )


def segment_counts(fp: Column) -> Column:
    """The bit count of each segment, in the segment's own four bits."""
    ones = F.lit(0x1111111111111111).cast("bigint")
    return sum((F.shiftrightunsigned(fp, i).bitwiseAND(ones) for i in range(1, SEGMENT)), fp.bitwiseAND(ones))


def _near_cells(cell: Column) -> Column:
    """The cell and those one step away, null where a step would leave the grid."""
    steps = [cell]
    for i in range(SEGMENTS):
        count = F.shiftrightunsigned(cell, SEGMENT * i).bitwiseAND(F.lit(15).cast("bigint"))
        one = F.lit(1 << SEGMENT * i).cast("bigint")
        steps += [F.when(count < SEGMENT, cell + one), F.when(count > 0, cell - one)]
    return F.array(*steps)


def _bits_apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``a, b`` over distinct fingerprints ``fp``: each within ``MAX_BITS``, and enough to reach all that are."""
    placed = stage_table(
        distinct.withColumn("cell", F.explode(_near_cells(segment_counts(F.col("fp"))))).filter("cell IS NOT NULL"),
        "cells",
    )
    shared = stage_table(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared_cells")
    met = stage_table(placed.join(shared, "cell"), "met")

    few = met.filter(F.col("n") <= CELL_PAIRS).groupBy("cell").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    near = F.filter("fps", lambda b: (b > F.col("a")) & (_bits_apart(F.col("a"), b) <= MAX_BITS))
    pairs = few.select("fps", F.explode("fps").alias("a")).select("a", F.explode(near).alias("b"))

    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(_shifted(i)))
    meeting = F.explode(F.concat(F.array("fp"), flips))
    many = met.filter(F.col("n") > CELL_PAIRS).select("fp", "cell", meeting.alias("at"))
    many = stage_table(many.filter(segment_counts(F.col("at")) == F.col("cell")).select("fp", "at"), "meetings")
    lowest = stage_table(
        many.groupBy("at").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "lowest"
    )
    stars = many.join(lowest, "at").filter("fp <> b").selectExpr("fp AS a", "b")
    return pairs.unionByName(stars).distinct()


def _shifted(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def grouped(docs: DataFrame, words_in: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` of every row; ``root`` tells components apart."""
    marks = stage_table(fingerprints(docs, words_in), "fingerprints")
    distinct = stage_table(marks.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_fingerprints")
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = stage_table(rooted, "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = stage_table(rooted.join(ids, "root").select("fp", "root", "component_id"), "components")
    return marks.join(known, "fp")


def near_duplicates(docs: DataFrame, words_in: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    return grouped(docs, words_in).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words_in: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component with all its columns: the smallest id, then the smallest text hash.

    Rows equal in both are told apart by their other plain columns, nulls first.
    """
    return first_rows(docs, grouped(docs, words_in))


def first_rows(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The first row of each ``root`` of ``groups``, which has ``doc_id, text_key, root`` of every row."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = groups.groupBy("root").agg(F.min(order).alias("first"))
    kept = stage_table(kept.select("first.doc_id", "first.text_key"), "kept").distinct()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(text_of()).alias("key")
    )
    stay = rows.join(
        kept, rows["id"].eqNullSafe(kept["doc_id"]) & (rows["key"] == kept["text_key"]), "left_semi"
    )
    plain = [f"row.`{f.name}`" for f in docs.schema.fields if f.dataType.typeName() in PLAIN and f.name != "text"]
    first = Window.partitionBy("id", "key").orderBy(*[F.asc_nulls_first(c) for c in plain or ["id"]])
    return stay.withColumn("place", F.row_number().over(first)).filter("place = 1").select("row.*")


PLAIN = {"string", "boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "decimal"}
