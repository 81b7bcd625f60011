"""Counting passes of the exact quantiles."""

import math

import numpy as np

from civicloom.functions import quantiles


def test_quantiles_of_many_columns(spark):
    """Columns of odd names, narrow and wide, with NULL, NaN and infinities, all narrowed down together."""
    rng = np.random.default_rng(2)
    n = 3000
    columns = {
        "v": rng.normal(size=n).tolist(),
        "interval": (rng.integers(0, 5, n) * 1.0).tolist(),
        "a.b": np.exp(rng.normal(size=n) * 20).tolist(),
        "0": (1e15 + rng.integers(0, 10**6, n)).tolist(),
        "bin": [math.inf, -math.inf, *(-rng.random(n - 2)).tolist()],
        "gaps": [None if k % 3 == 0 else math.nan if k % 3 == 1 else float(k) for k in range(n)],
        "one": [7.0] * n,
    }
    schema = ", ".join(f"`{c}` double" for c in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema).repartition(3)
    at = (0.001, 0.25, 0.5, 0.75, 0.999)
    got = quantiles.exact_quantiles(df, quantiles.column_bounds(df, list(columns)), at)
    for c, values in columns.items():
        real = sorted(v for v in values if v is not None and not math.isnan(v))
        for p in at:
            place = (len(real) - 1) * p
            low, high = real[math.floor(place)], real[math.ceil(place)]
            assert got[c, p] == low + (high - low) * (place - math.floor(place)), (c, p)


def test_a_pass_is_an_expansion(spark):
    """Values become rows by plain columns; arrays of structs per row took most of a pass."""
    df = spark.range(10).selectExpr("id * 1.0D AS x", "id * 2.0D AS y")
    intervals = [quantiles._Interval("x", 2.0, 5.0, 2), quantiles._Interval("y", 0.0, 4.0, 0), quantiles._Interval("x", 9.0, 9.0, 9)]
    hits = quantiles._hits(df, intervals)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan
    assert sorted((r.interval, r.v) for r in hits.collect()) == [
        *[("0", float(v)) for v in (2, 3, 4, 5)], *[("1", float(v)) for v in (0, 2, 4)], ("2", 9.0)
    ]
