"""What the optimizer makes of the main operators."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from civicloom.functions import quantiles
from civicloom.operators import anomaly, classify, marts
from civicloom.operators.gates import GateContext
from civicloom.plans import catalog
from civicloom.plans.pipeline import build_gold
from civicloom.sources import driver_tables as given


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, sf):
    return catalog._stored_silver(spark, sf)


def test_daily_reads_only_its_columns(silver):
    text = plan(marts.daily_complaints(silver))
    scan = text.split("FileScan parquet [")[1].split("]")[0]
    read = {column.split("#")[0] for column in scan.split(",")}
    assert read == {"complaint_date", "borough", "status", "resolution_days", "is_resolution_anomaly"}
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_scan(silver):
    text = plan(marts.resolution_anomalies(silver))
    assert "PushedFilters: [IsNotNull(is_resolution_anomaly), EqualTo(is_resolution_anomaly,true)]" in text
    assert "Exchange" not in text


@pytest.mark.parametrize("mode", ["month", "asof"])
def test_incidents_never_shuffle_complaints(spark, sf, silver, mode):
    macro = catalog._macro(spark, sf)
    text = plan(marts.property_incidents(silver, macro, mode))
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text and "NestedLoop" not in text
    left = text[: text.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in left


def test_silver_shuffles_once(spark, sf):
    text = plan(catalog._silver(spark, sf))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("WindowGroupLimit") == 2


def test_classification_is_one_projection(spark, sf):
    text = plan(classify.classify(given.classified_lines(spark, sf), "aviation"))
    assert "Exchange" not in text and "Python" not in text and "Join" not in text


def test_a_hot_key_of_close_values_is_never_sorted(spark, monkeypatch):
    """A million values within a thousandth, next to a small key: what is ordered are a few thousand of them."""
    hot = spark.range(1_000_000).select(F.lit("hot").alias("k"), (1000 + F.col("id") / 1e6).alias("v"))
    df = hot.unionByName(spark.range(10).select(F.lit("cold").alias("k"), F.col("id").cast("double").alias("v")))
    found = []
    kept = quantiles.middle_bins
    monkeypatch.setattr(quantiles, "middle_bins", lambda *args: found.append(kept(*args)) or found[-1])
    rows = quantiles.grouped_summary(df, "k", "v")
    assert {r.k: (r["count"], r.median) for r in rows.collect()} == {"hot": (1_000_000, pytest.approx(1000.4999995)), "cold": (10, 4.5)}
    widest = found[0].agg(F.max("cells")).first()[0]
    assert widest <= quantiles.MIDDLE_CELLS
    # The one sort by value is behind the join with the middle bins.
    final = plan(rows).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "CartesianProduct" not in final and "NestedLoop" not in final
    assert final.count("FileScan") >= 2 and "Range" not in final


def test_no_query_holds_a_cross_join(spark, sf):
    for name in ("borough_summary", "zscore_anomalies", "gate_quarantine", "gate_reconciliation", "validation_report", "log_verdicts"):
        text = plan(catalog.QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_gold_build_end_to_end(spark, sf, tmp_path):
    ctx = GateContext("gold", "r1", datetime(2024, 1, 31))
    manifest = build_gold(
        given.raw_complaints(spark, sf), marts.pivot_macro(catalog._newest_macro(spark, sf)), ctx, str(tmp_path), given.TIE_BREAKERS
    )
    counts = {r.table_name: r.row_count for r in manifest.collect()}
    assert len(counts) == 7 and min(counts.values()) > 0
    daily = spark.read.parquet(f"{tmp_path}/gold/daily_complaints")
    assert daily.agg(F.sum("total_complaints")).first()[0] == spark.read.parquet(f"{tmp_path}/silver/complaints").count()


def test_risk_score_expands_no_row(spark, sf):
    text = plan(marts.address_risk_score(catalog._silver(spark, sf), datetime(2024, 1, 31)))
    assert "Expand" not in text


def test_bronze_json_files_stay_small(spark, sf, tmp_path, monkeypatch):
    path = str(tmp_path / "json")
    monkeypatch.setattr(catalog, "stage_path", lambda *_: path)
    monkeypatch.setattr(catalog, "JSON_FILE_ROWS", 1000, raising=False)
    rows = catalog.bronze_json(spark, sf).count()
    stored = spark.read.text(path).agg(F.sum(F.length("value")), F.count("value")).first()
    files = list((tmp_path / "json").glob("part-*"))
    assert rows and stored[1] >= rows
    assert 4 * sum(f.stat().st_size for f in files) < stored[0]
    assert max(r[1] for r in spark.read.text(path).groupBy("_metadata.file_name").count().collect()) <= 1000


def test_joined_complaints_are_not_shuffled_again(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalog._silver(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" in text and "hashpartitioning(complaint_id" not in text
    assert text.count("Exchange hashpartitioning(l_orderkey") == 1
