"""Long tables of ``list, node``: lists of equal members once, long lists in blocks that meet two at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from civicloom.session import stage_table


def lists_once(keyed: DataFrame) -> DataFrame:
    """``list, n`` of one list of each set of two or more members."""
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"s{i}") for i in range(2)]
    sizes = keyed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), *marks).filter("n > 1")
    return stage_table(sizes.groupBy("n", "s0", "s1").agg(F.min("list").alias("list")).select("list", "n"), "list_sizes")


def meeting(rows: DataFrame, block: Column, blocks: Column) -> DataFrame:
    """Adds ``block, low, high``: each row with every block of its list, its own included."""
    placed = rows.withColumn("blocks", blocks.cast("bigint")).withColumn("block", F.pmod(block, F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    placed = placed.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return placed.drop("blocks", "other")


def by_group(rows: DataFrame, keys: list[str], work: Callable, schema: str) -> DataFrame:
    """``work(table)`` for each group of equal keys, where a group is bounded and most are tiny."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(last: bool) -> Iterator[pa.Table]:
            nonlocal held
            table = pa.Table.from_batches(held).combine_chunks()
            values = [table.column(k).to_numpy() for k in keys]
            changed = np.any([v[1:] != v[:-1] for v in values], axis=0)
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), len(table)]
            for a, b in zip(cuts[: len(cuts) - 1 if last else -2], cuts[1:]):
                yield table.slice(a, b - a)
            held = [] if last else table.slice(cuts[-2]).to_batches()

        def results(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
            found = [x for x in map(work, tables) if len(x[0])]
            columns = [np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

        for batch in batches:
            if len(batch):
                held.append(batch)
                yield from results(groups(False))
        if held:
            yield from results(groups(True))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
