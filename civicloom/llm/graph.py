"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from civicloom.session import stage_table


def _links(df: DataFrame, high: str, low: str) -> DataFrame:
    return df.select(F.col(high).alias("u"), F.col(low).alias("v")).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node that has an edge; the root is the component's smallest node.

    ``edges`` has two long columns, ``a`` and ``b``; direction, repeats and loops don't
    matter. Each step is written to the shared folder, so lineage stays short. A hub's
    minimum is a partial aggregate, and is written before it joins the hub's edges, so
    that the join can split a hub.
    """
    current = stage_table(_links(edges.selectExpr("greatest(a, b) AS u", "least(a, b) AS v"), "u", "v"), "edges")
    state = _state(current)
    while state[0]:
        both = current.union(current.select("v", "u"))
        low = stage_table(both.groupBy("u").agg(F.least(F.min("v"), "u").alias("m")), "large_star")
        large = both.filter("v > u").join(low, "u").select("v", "m")
        large = stage_table(_links(large, "v", "m"), "edges")
        low = stage_table(large.groupBy("u").agg(F.min("v").alias("m")), "small_star")
        small = large.join(low, "u").select("v", "m").union(low.select("u", "m"))
        current = stage_table(_links(small, "v", "m"), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return current.selectExpr("u AS node", "v AS root").unionByName(
        current.selectExpr("v AS node", "v AS root").distinct()
    )
