"""Large JSON array files, each read by many tasks.

A JSON reader must see a document from its start, so one file is one task. Here a file is
read as text that ends at closing braces, which Spark splits like any text. A first pass
finds what each split does to the state a reader is in, namely whether it is inside a string and how
deep, for both states it may begin in; running sums over a file's splits tell the state each
one does begin in. A second pass then cuts the splits into objects. Objects that lie
across splits come as fragments and are put together at the end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from civicloom.session import stage_table

#: So many splits' states are broadcast, some 100 bytes each; more are joined by shuffle.
MOST_BROADCAST = 200_000
_ESCAPED = re.compile(r"\\.", re.S)
_SPLIT = "file string, block bigint"


def _parts(piece: str) -> list[str]:
    """The text between quotation marks, in turn outside and inside strings (or the other way round)."""
    return _ESCAPED.sub("", piece).split('"')


def _depth(parts: list[str]) -> int:
    return sum(p.count("{") + p.count("[") - p.count("]") for p in parts)


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, block, value``: the text up to each closing brace. Rows of a split come in order."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _states(pieces: DataFrame) -> DataFrame:
    """``file, block, quotes, outside, inside, first``: a split's quotation marks, what it adds to the depth if it
    begins outside or inside a string, and its first character. A file's last piece counts as ending at a brace, too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list] = {}
        for batch in batches:
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                state = found.setdefault((file, block), [0, 0, 0, ""])
                parts = _parts(value)
                even, odd = _depth(parts[0::2]), _depth(parts[1::2])
                if state[0] % 2:
                    even, odd = odd, even
                state[0] += len(parts) - 1
                # The brace is outside if the marks so far leave the state that the split begins in, or flip an inside.
                state[1] += even - (state[0] % 2 == 0)
                state[2] += odd - (state[0] % 2 == 1)
                state[3] = state[3] or value.lstrip()[:1]
        rows = [(*key, *state) for key, state in found.items()]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*rows)) or [()] * 6
        names = ["file", "block", "quotes", "outside", "inside", "first"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return pieces.mapInArrow(run, f"{_SPLIT}, quotes bigint, outside bigint, inside bigint, first string")


def _starts(states: DataFrame) -> DataFrame:
    """``file, block, in_string, depth, base``: what each split begins in. An array's objects end at depth one, others at none."""
    # A file's splits, one row each; a file has as many as it has blocks.
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = states.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    rows = rows.withColumn("delta", F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside")))
    head = F.first(F.when(F.col("first") != "", F.col("first")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return rows.select(
        "file", "block", "in_string", F.coalesce(F.sum("delta").over(before), F.lit(0)).alias("depth"),
        F.when(head == "[", 1).otherwise(0).cast("bigint").alias("base"),
    )


def _cut(rows: DataFrame) -> DataFrame:
    """``file, block, place, text``: whole objects have no place; a fragment that ends one has 0, one that begins one 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, depth, inside, base, whole = None, [], 0, False, 0, True
        kinds, names = [pa.string(), pa.int64(), pa.int32(), pa.string()], ["file", "block", "place", "text"]

        def fragment() -> list[tuple]:
            """What is left of a split: the start of an object, or more of one that began before."""
            text = "}".join(held)
            if whole:
                text = text[text.index("{"):] if "{" in text else ""
            return [(*at, 1 if whole else 0, text)] if text else []

        for batch in batches:
            found = []
            for file, block, value, in_string, start, its_base in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != at:
                    if at:
                        found += fragment()
                    at, held, depth, inside, base = (file, block), [], start, in_string, its_base
                    whole = depth <= base and not inside
                parts = _parts(value)
                depth += _depth(parts[1::2] if inside else parts[0::2])
                inside ^= len(parts) % 2 == 0
                held.append(value)
                if not inside:
                    depth -= 1
                    if depth == base:
                        text = "}".join(held) + "}"
                        found.append((*at, None, text[text.index("{"):]) if whole else (*at, 0, text))
                        held, whole = [], True
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if at:
            columns = list(zip(*fragment())) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return rows.mapInArrow(run, f"{_SPLIT}, place int, text string")


def array_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, text``: each top-level object of the files' arrays, as it is written there.

    Files may also hold one object, or objects one after the other. An object that breaks off
    with its file comes as far as it goes. The files are read twice.
    """
    pieces = _pieces(spark, path)
    starts = stage_table(_starts(_states(pieces)), "split_starts")
    few = starts.count() <= MOST_BROADCAST
    numbered = pieces if few else pieces.withColumn("row", F.monotonically_increasing_id())
    rows = numbered.join(F.broadcast(starts) if few else starts, ["file", "block"])
    if not few:  # a shuffle loses the order within a split
        rows = rows.sortWithinPartitions("file", "block", "row")
    cut = stage_table(_cut(rows.select("file", "block", "value", "in_string", "depth", "base")), "array_objects")
    # A file has at most two fragments a split. Each that begins an object opens a group.
    order = Window.partitionBy("file").orderBy("block", "place")
    parts = cut.filter("place IS NOT NULL").withColumn("number", F.sum("place").over(order))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "place", "text"))), lambda p: p["text"]), "}")
    # A fragment that doesn't end its object was cut at a brace, one that does holds its own.
    joined = parts.groupBy("file", "number").agg(text.alias("text")).select("file", "text")
    return cut.filter("place IS NULL").select("file", "text").unionByName(joined)


def read_json_arrays(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Like ``read_json_bronze`` for array files of any size: an object is a row, and one that doesn't parse is left out.

    Of a file that breaks off, the objects before are read.
    """
    marked = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    parsed = F.from_json("text", marked, {"columnNameOfCorruptRecord": "_malformed"})
    rows = array_objects(spark, path).select(parsed.alias("e")).filter(F.col("e._malformed").isNull())
    return rows.select(*[F.col(f"e.`{c}`") for c in schema.fieldNames()])
