import math
from datetime import date, datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, example, given, settings, strategies as st
from pyspark.sql import functions as F

from civicloom import schemas
from civicloom.functions import quantiles
from civicloom.operators import anomaly, gates


def frame(spark, values, name="v"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} double")


# --- order statistics ---


@pytest.mark.parametrize("bins", [16, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy(spark, monkeypatch, bins, seed):
    monkeypatch.setattr(quantiles, "BINS", bins)
    rng = np.random.default_rng(seed)
    shapes = {
        "uniform": rng.random(3000), "heavy": rng.standard_cauchy(3000), "ties": rng.integers(0, 5, 3000).astype(float),
        "hot": np.where(rng.random(3000) < 0.4, 100.0, rng.normal(0, 1, 3000)), "wide": np.exp(rng.normal(0, 40, 3000)),
    }
    df = spark.createDataFrame(list(map(tuple, np.column_stack(list(shapes.values())).tolist())), list(shapes))
    probabilities = (0.0, 0.25, 0.5, 0.95, 0.99, 1.0)
    got = quantiles.exact_quantiles(df, quantiles.column_bounds(df, list(shapes)), probabilities)
    for name, values in shapes.items():
        for p in probabilities:
            assert got[name, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-300)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=30), st.data())
@example([math.inf, -math.inf, 1.7e308, -1.7e308, 0.0, -0.0, 5e-324], None)
def test_every_rank(spark, values, data):
    df = frame(spark, [*values, None, math.nan])
    ranks = set(range(len(values)))
    got = quantiles.values_at_ranks(df, quantiles.column_bounds(df, ["v"]), {"v": ranks})
    assert [got["v", r] for r in sorted(ranks)] == sorted(values)


def test_quantiles_of_integers_and_of_nothing(spark):
    df = spark.range(101).select(F.col("id").alias("n"), F.lit(None).cast("int").alias("none"))
    got = quantiles.exact_quantiles(df, quantiles.column_bounds(df, ["n", "none"]), (0.5, 0.95))
    assert got == {("n", 0.5): 50.0, ("n", 0.95): 95.0}


def test_each_pass_collects_bins_not_values(spark):
    """What reaches the driver is bounded by the number of bins."""
    df = frame(spark, np.random.default_rng(0).random(20000).tolist())
    bounds = quantiles.column_bounds(df, ["v"])
    interval = quantiles._Interval("v", bounds["v"].low, bounds["v"].high, 0)
    found = quantiles._narrow(df, {interval: {10000}})
    inner = found[interval][10000]
    assert inner.below <= 10000 and inner.high - inner.low < 1e-3


# --- findings ---


def test_zscore(spark):
    values = [1.0, 2.0, 3.0] * 20 + [60.0]
    rows = anomaly.zscore_anomalies(frame(spark, values), "t", ["id"]).collect()
    mean, std = np.mean(values), np.std(values, ddof=1)
    assert [(r.row_key, r.value, r.severity) for r in rows] == [("60", 60.0, "high")]
    assert rows[0].zscore == pytest.approx((60 - mean) / std) and rows[0].std == pytest.approx(std)


def test_zscore_skips_short_and_flat_columns(spark):
    nine = frame(spark, [0.0] * 8 + [1e9] + [None] * 5 + [math.nan])
    assert anomaly.zscore_anomalies(nine, "t", ["id"], threshold=0.1).count() == 0
    flat = frame(spark, [5.0] * 20)
    assert anomaly.zscore_anomalies(flat, "t", ["id"], threshold=0.0).count() == 0
    ten = frame(spark, [0.0] * 9 + [1e9])
    assert anomaly.zscore_anomalies(ten, "t", ["id"], threshold=2.8).count() == 1


def test_only_numbers_are_numeric(spark):
    df = spark.createDataFrame(
        [(1, True, date(2024, 1, 1), "x", 1.5)], "i int, b boolean, d date, s string, f double"
    )
    assert anomaly.numeric_columns(df) == ["i", "f"]
    assert anomaly.zscore_anomalies(df.select("s"), "t", ["s"]).count() == 0
    assert anomaly.iqr_anomalies(df.select("s"), "t", ["s"]).count() == 0


def test_iqr(spark):
    values = list(range(20)) + [100.0, -50.0, None]
    rows = anomaly.iqr_anomalies(frame(spark, [None if v is None else float(v) for v in values]), "t", ["id"]).collect()
    q1, q3 = np.quantile([v for v in values if v is not None], [0.25, 0.75])
    assert {(r.row_key, r.value, r.severity) for r in rows} == {("20", 100.0, "medium"), ("21", -50.0, "medium")}
    assert rows[0].lower_bound == pytest.approx(q1 - 1.5 * (q3 - q1))
    assert rows[0].upper_bound == pytest.approx(q3 + 1.5 * (q3 - q1))


def test_iqr_fence_itself_is_inside_and_flat_columns_are_skipped(spark):
    base = [0.0] * 5 + [1.0] * 5 + [2.0] * 5 + [3.0] * 5  # quartiles 0.75 and 2.25 move little
    df = frame(spark, base)
    assert anomaly.iqr_anomalies(df, "t", ["id"]).count() == 0
    assert anomaly.iqr_anomalies(frame(spark, [7.0] * 30 + [900.0]), "t", ["id"]).count() == 0


def test_baseline(spark):
    df = frame(spark, [1.0, 2.0] * 20 + [500.0])
    findings, profiles, absent = anomaly.anomaly_baseline({"t": (df, ["id"]), "gone": (None, [])})
    assert absent == ["gone"]
    assert {(r.anomaly_type, r.value) for r in findings.collect()} == {("zscore_outlier", 500.0), ("iqr_outlier", 500.0)}
    assert {"zscore", "lower_bound"} < set(findings.columns)
    assert profiles.count() == 2
    with pytest.raises(ValueError):
        anomaly.anomaly_baseline({"gone": (None, [])})


def test_profile_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "n int, s string")
    got = {r.column_name: (r.row_count, r.column_count, r.is_numeric, r.null_count) for r in anomaly.profile_table(df, "t").collect()}
    assert got == {"n": (3, 2, True, 1), "s": (3, 2, False, 2)}


# --- scores ---


def scores(spark, rows):
    return spark.createDataFrame(rows, "full_address string, zip_code string, borough string, property_risk_score double")


def test_detect_columns(spark):
    named = scores(spark, [("a", "1", "b", 5.0)])
    assert anomaly.detect_columns(named) == {
        "score": "property_risk_score", "address": "full_address", "zip": "zip_code", "borough": "borough",
    }
    unnamed = spark.createDataFrame([(-1, 500, 7, None)], "a int, b int, c int, d int")
    assert anomaly.detect_columns(unnamed) == {"score": "c", "address": None, "zip": None, "borough": None}
    assert anomaly.detect_columns(unnamed.select("a", "d"))["score"] is None


def test_profile_score(spark):
    df = scores(spark, [("a", "1", "b", 10.0), ("a", "1", "b", 20.0), (None, "1", "b", None), (None, "1", "b", 130.0)])
    row = anomaly.score_warnings(anomaly.profile_score(df, "property_risk_score", "full_address")).first()
    assert (row.row_count, row.null_score_count, row.min_score, row.max_score) == (4, 1, 10.0, 130.0)
    assert row.median_score == 20.0 and row.p95_score == pytest.approx(np.quantile([10, 20, 130], 0.95))
    assert row.duplicate_address_count == 2
    assert row.warnings == ["null_scores", "score_above_100"]


def test_profile_of_empty_scores(spark):
    row = anomaly.profile_score(scores(spark, [("a", "1", "b", None)]), "property_risk_score").first()
    assert (row.min_score, row.median_score, row.duplicate_address_count) == (None, None, None)


def test_score_by(spark):
    rows = [("a", "1", "b", 1.0), ("a", "1", "b", 1.0), ("a", "1", "b", 4.0), ("a", "1", "b", 9.0), ("a", "1", "b", None),
            ("a", "2", "b", None), ("a", None, "b", 3.0), ("a", "3", "b", 7.0)]
    got = {r.zip_code: tuple(r)[1:] for r in anomaly.score_by(scores(spark, rows), "zip_code", "property_risk_score").collect()}
    assert got == {"1": (4, 3.75, 2.5, 1.0, 9.0), "2": (0, None, None, None, None), "3": (1, 7.0, 7.0, 7.0, 7.0)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.floats(-1e6, 1e6), st.integers(0, 3).map(float))), min_size=5, max_size=60))
def test_score_by_against_numpy(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in anomaly.score_by(df, "k", "v").collect()}
    assert set(got) == {k for k, _ in rows}
    for k, row in got.items():
        values = [v for key, v in rows if key == k and v is not None]
        assert row["count"] == len(values)
        if values:
            assert row["median"] == pytest.approx(np.median(values), rel=1e-12, abs=1e-12)
            assert row["mean"] == pytest.approx(np.mean(values), rel=1e-9, abs=1e-9)
            assert (row["min"], row["max"]) == (min(values), max(values))


@pytest.mark.parametrize("n, keep", [(0, 0), (7, 7), (500, 10), (1999, 19), (3000, 30)])
def test_top_share(spark, n, keep):
    rows = [(f"a{i:05d}", "1", "b", float(min(100, i % 150))) for i in range(n)]
    df = scores(spark, rows)
    got = anomaly.top_share(df, "property_risk_score", [F.asc("full_address")]).orderBy("score_rank").collect()
    want = sorted(rows, key=lambda r: (-r[3], r[0]))[:keep]
    assert [r.full_address for r in got] == [w[0] for w in want]
    assert [r.score_rank for r in got] == list(range(1, keep + 1))


def test_top_share_reaches_rows_without_a_score(spark):
    df = scores(spark, [(f"a{i}", "1", "b", float(i) if i < 4 else None) for i in range(12)])
    got = anomaly.top_share(df, "property_risk_score", [F.asc("full_address")]).orderBy("score_rank").collect()
    assert len(got) == 10 and [r.property_risk_score for r in got[:5]] == [3.0, 2.0, 1.0, 0.0, None]


def test_tail(spark):
    rows = anomaly.tail(spark.range(100), ["id"], 3).collect()
    assert sorted(r.id for r in rows) == [97, 98, 99]


# --- report ---


def classified(spark, **counts):
    rows = [(s, s not in ("valid", "pending")) for s, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "validation_status string, quarantine_flag boolean")


def test_report(spark):
    records = classified(spark, valid=3, pending=1, invalid=2, quarantine_candidate=4)
    findings = frame(spark, [1.0, 2.0])
    profile = anomaly.score_warnings(anomaly.profile_score(frame(spark, [-5.0, 3.0]), "v"))
    row = anomaly.validation_report(spark, records, findings, profile, ["x"]).first()
    assert (row.valid_count, row.pending_count, row.invalid_count, row.quarantine_count, row.anomaly_count) == (3, 1, 2, 6, 2)
    assert row.blocking_failures == ["invalid_records:2"]
    assert row.warnings == ["missing_tables:x", "score:score_below_0"]
    assert row.promotion_recommendation == "REVIEW"


def test_report_of_nothing_feeds_the_gate(spark):
    report = anomaly.validation_report(spark, None, None, None)
    row = report.first()
    assert row.valid_count == 0 and row.blocking_failures == ["score:no_score"] and row.warnings == []
    now = datetime(2024, 1, 1, 12)
    table = anomaly.report_rows(report, "gold.t", "r1", datetime(2024, 1, 1, 11))
    assert table.columns == schemas.VALIDATION_REPORT.fieldNames()
    verdict = gates.validation_gate(spark, table, gates.GateContext("gold.t", "r1", now)).first()
    assert verdict.status == "warn"
