from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from civicloom.functions.windows import global_rank, keep_latest, top_value, with_time_index
from civicloom.operators import silver
from civicloom.schemas import BRONZE_COMPLAINT


def raw(spark, *rows):
    names = BRONZE_COMPLAINT.fieldNames()
    filled = [tuple(row.get(n) for n in names) for row in rows]
    return spark.createDataFrame(filled, BRONZE_COMPLAINT)


def test_clean_complaints(spark):
    row = silver.clean_complaints(
        raw(
            spark,
            {
                "unique_key": "1", "created_date": "2024-03-01T23:30:00.000", "closed_date": "2024-03-02T00:10:00.000",
                "complaint_type": " Noise ", "descriptor": " loud ", "status": " closed ", "borough": "queens",
                "incident_address": " 1 Main St ", "latitude": "40.5", "open_data_channel_type": " phone ",
            },
        )
    ).first()
    assert row.created_date == datetime(2024, 3, 1, 23, 30)
    assert row.resolution_days == 1  # midnights crossed, not 24 hour spans
    assert row.complaint_type == "NOISE" and row.status == "CLOSED" and row.borough == "QUEENS"
    assert row.incident_address == "1 Main St" and row.channel_type == "PHONE"
    assert row.latitude == 40.5 and row.complaint_date == date(2024, 3, 1)
    assert row.is_resolution_anomaly is False


def test_open_and_early_complaints(spark):
    rows = silver.clean_complaints(
        raw(
            spark,
            {"unique_key": "open", "created_date": "2024-03-01T00:00:00"},
            {"unique_key": "early", "created_date": "2024-03-05T08:00:00", "closed_date": "2024-03-01T09:00:00"},
            {"unique_key": "hours", "created_date": "2024-03-05T08:00:00", "closed_date": "2024-03-05T07:00:00"},
        )
    ).collect()
    got = {r.complaint_id: (r.resolution_days, r.is_resolution_anomaly) for r in rows}
    assert got == {"open": (None, False), "early": (-4, True), "hours": (0, True)}


def test_borough_default_and_blank(spark):
    rows = silver.clean_complaints(
        raw(
            spark,
            {"unique_key": "none", "created_date": "2024-01-01"},
            {"unique_key": "blank", "created_date": "2024-01-01", "borough": "  "},
        )
    ).collect()
    assert {r.complaint_id: r.borough for r in rows} == {"none": "UNSPECIFIED", "blank": ""}


def test_required_keys_and_bad_values(spark):
    rows = raw(
        spark,
        {"created_date": "2024-01-01"}, {"unique_key": "x"},
        {"unique_key": "bad", "created_date": "2024-01-01", "latitude": "north"},
    )
    kept = silver.clean_complaints(rows, on_bad="null").collect()
    assert [(r.complaint_id, r.latitude) for r in kept] == [("bad", None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.clean_complaints(rows).collect()


def test_stage_complaints_keeps_newest_and_is_idempotent(spark):
    rows = raw(
        spark,
        {"unique_key": "a", "created_date": "2024-01-01T00:00:00", "status": "old"},
        {"unique_key": "a", "created_date": "2024-01-02T00:00:00", "status": "new"},
        {"unique_key": "b", "created_date": "2024-01-01T00:00:00", "status": "open"},
        {"unique_key": "b", "created_date": "2024-01-01T00:00:00", "closed_date": "2024-01-03T00:00:00", "status": "done"},
    )
    latest = silver.stage_complaints(rows)
    assert {r.complaint_id: r.status for r in latest.collect()} == {"a": "NEW", "b": "DONE"}
    again = keep_latest(latest, ["complaint_id"], [F.desc("created_date")])
    assert sorted(again.collect()) == sorted(latest.collect())


def test_keep_latest_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    latest = keep_latest(df, ["k"], [F.desc("id")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")  # printed top down: below the exchange
    assert latest.filter("k = 0").first().id == 999
    assert latest.count() == df.select("k").distinct().count()


def test_top_value_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("p", "b"), ("p", "a"), ("q", None), ("q", None), ("q", "z")], "k string, v string")
    assert {r.k: (r.v, r.value_count) for r in top_value(df, ["k"], "v").collect()} == {"p": ("a", 1), "q": (None, 2)}


def test_time_index(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 9)], "g string, m int")
    assert {(r.g, r.m): r.t for r in with_time_index(df, "g", "m").collect()} == {("a", 1): 1, ("a", 3): 2, ("b", 9): 1}


def test_global_rank_agrees_with_plain_order(spark):
    rows = [(i, [50.0, None, 0.0, 100.0, 50.0][i % 5], i % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, rate double, days int")
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), -r[2], r[0]))
    ranked = global_rank(df, [F.col("rate").desc_nulls_last(), F.desc("days"), F.asc("id")], "rank")
    assert {r.id: r["rank"] for r in ranked.collect()} == {r[0]: n for n, r in enumerate(want, 1)}
    assert ranked.schema["rank"].dataType.simpleString() == "bigint"
    assert global_rank(df.limit(0), [F.asc("id")], "rank").count() == 0


def test_observations(spark):
    docs = spark.createDataFrame(
        [
            ("UNRATE", 1, [("2024-01-01", "3.7"), ("2024-02-01", ".")]),
            ("UNRATE", 2, [("2024-01-01", "3.8"), ("2024-03-01", "nan"), ("2024-04-01", "4")]),
        ],
        "series_id string, load_stamp int, observations array<struct<date:string,value:string>>",
    )
    rows = silver.stage_observations(docs, [F.desc("load_stamp")]).collect()
    assert sorted((r.observation_date, r.value) for r in rows) == [(date(2024, 1, 1), 3.8), (date(2024, 4, 1), 4.0)]
    assert silver.stage_observations(docs).count() == 3
