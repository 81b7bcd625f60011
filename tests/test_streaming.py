import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from civicloom import schemas
from civicloom.functions.windows import keep_latest
from civicloom.operators import marts, silver
from civicloom.streaming import streams


def put(path, name, *rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text(json.dumps(list(rows)))


def complaint(key, created, status="Open", borough="queens", closed=None):
    row = {"unique_key": key, "created_date": created, "status": status, "borough": borough}
    return {**row, "closed_date": closed} if closed else row


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "bronze"
    put(path, "p0.json", complaint("1", "2024-01-01T10:00:00"), complaint("2", "2024-01-01T23:59:59", "Closed", closed="2024-01-04T00:00:00"))
    put(path, "p1.json", complaint("1", "2024-01-02T10:00:00", "Closed"), complaint("3", "2024-01-02T11:00:00"))
    return path


def stream(spark, folder):
    return silver.clean_complaints(streams.stream_bronze(spark, str(folder), schemas.BRONZE_COMPLAINT, max_files=1))


def batch(spark, folder):
    from civicloom.sources.readers import read_json_bronze

    return silver.clean_complaints(read_json_bronze(spark, str(folder), schemas.BRONZE_COMPLAINT))


def test_stream_daily_equals_batch(spark, folder):
    got = streams.run_daily(stream(spark, folder))
    assert sorted(got.collect()) == sorted(marts.daily_complaints(batch(spark, folder)).select(got.columns).collect())


KEYS = ["complaint_id"]


def newest():
    return [F.desc("created_date")]


def run_latest(spark, folder, tmp_path):
    query = streams.stream_keep_latest(stream(spark, folder), f"{tmp_path}/t", f"{tmp_path}/c", KEYS, newest())
    query.awaitTermination()
    return streams.latest_view(spark, f"{tmp_path}/t", KEYS, newest())


def test_stream_keep_latest_equals_batch_and_resumes(spark, folder, tmp_path):
    first = run_latest(spark, folder, tmp_path)
    assert {r.complaint_id: r.status for r in first.collect()} == {"1": "CLOSED", "2": "CLOSED", "3": "OPEN"}
    stored = spark.read.parquet(f"{tmp_path}/t").count()
    assert run_latest(spark, folder, tmp_path).count() == 3
    assert spark.read.parquet(f"{tmp_path}/t").count() == stored  # each file once
    put(folder, "p2.json", complaint("3", "2024-01-05T00:00:00", "Closed"), complaint("1", "2023-01-01T00:00:00"))
    again = run_latest(spark, folder, tmp_path)
    assert {r.complaint_id: r.status for r in again.collect()} == {"1": "CLOSED", "2": "CLOSED", "3": "CLOSED"}
    want = keep_latest(batch(spark, folder), KEYS, newest())
    assert sorted(again.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_compaction_changes_nothing(spark, folder, tmp_path):
    view = run_latest(spark, folder, tmp_path)
    want = sorted(view.collect(), key=str)
    streams.compact(spark, f"{tmp_path}/t", KEYS, newest())
    compacted = streams.latest_view(spark, f"{tmp_path}/t", KEYS, newest())
    assert sorted(compacted.select(view.columns).collect(), key=str) == want


def test_the_stream_goes_on_after_compaction(spark, folder, tmp_path):
    target = f"{tmp_path}/t"
    run_latest(spark, folder, tmp_path)
    streams.compact(spark, target, KEYS, newest())
    streams.retire(spark, target)
    put(folder, "p3.json", complaint("3", "2024-02-05T00:00:00", "Closed"), complaint("9", "2024-02-01T00:00:00"))
    run_latest(spark, folder, tmp_path)
    (tmp_path / "t.base" / "upto=99").mkdir()  # a base whose writing broke off
    assert streams.compact(spark, target, KEYS, newest()) < 99
    assert streams.retire(spark, target) > 0
    got = streams.latest_view(spark, target, KEYS, newest())
    want = keep_latest(batch(spark, folder), KEYS, newest())
    assert sorted(got.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_compaction_rewrites_only_buckets_with_new_keys(spark, folder, tmp_path):
    """Files of buckets without new keys stay, in any number of compactions; the view is that of all batches."""
    target, base = f"{tmp_path}/t", tmp_path / "t.base"
    put(folder, "p2.json", *[complaint(f"k{i}", "2024-01-03T10:00:00") for i in range(200)])
    run_latest(spark, folder, tmp_path)
    first = streams.compact(spark, target, KEYS, newest(), buckets=16)
    before = {p: p.stat().st_mtime_ns for p in base.glob(f"upto={first}/*/*.parquet")}
    put(folder, "p3.json", complaint("k7", "2024-03-03T10:00:00", "Closed"), complaint("k9", "2024-03-04T10:00:00"))
    run_latest(spark, folder, tmp_path)
    second = streams.compact(spark, target, KEYS, newest())
    assert second > first and 1 <= len(list(base.glob(f"upto={second}/key_bucket=*"))) <= 2
    assert streams.compact(spark, target, KEYS, newest()) == second  # nothing new
    streams.retire(spark, target)
    kept = {p: p.stat().st_mtime_ns for p in base.glob(f"upto={first}/*/*.parquet")}
    assert 14 <= len({p.parent for p in kept}) < len({p.parent for p in before}) <= 16 and kept.items() <= before.items()
    got = streams.latest_view(spark, target, KEYS, newest())
    want = keep_latest(batch(spark, folder), KEYS, newest())
    assert sorted(got.select(want.columns).collect(), key=str) == sorted(want.collect(), key=str)


def test_a_replayed_batch_replaces_itself(spark, folder, tmp_path):
    run_latest(spark, folder, tmp_path)
    before = spark.read.parquet(f"{tmp_path}/t").count()
    # A second checkpoint replays the same files under the same batch ids.
    query = streams.stream_keep_latest(stream(spark, folder), f"{tmp_path}/t", f"{tmp_path}/other", KEYS, newest())
    query.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/t").count() == before


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    path = tmp_path / "bronze"
    put(path, "p0.json", complaint("1", "2024-01-10T10:00:00"))
    checkpoint, target = f"{tmp_path}/c", f"{tmp_path}/t"

    def run():
        daily = streams.stream_daily(stream(spark, path), "1 day")
        query = streams.write_batches(daily, target, checkpoint, mode="update")
        query.awaitTermination()
        return query

    listener = streams.LateRows()
    spark.streams.addListener(listener)
    first = run()
    assert streams.late_row_count(listener, first) == 0
    put(path, "p1.json", complaint("2", "2024-01-11T10:00:00"))
    run()
    put(path, "p2.json", complaint("3", "2024-01-02T10:00:00"), complaint("4", "2024-01-12T10:00:00"))
    assert streams.late_row_count(listener, run()) == 1
    spark.streams.removeListener(listener)
    days = {r.complaint_date.day for r in spark.read.parquet(target).collect()}
    assert days == {10, 11, 12}


def late_ids(spark, target, schema):
    return {r.complaint_id: (r.late_reason, r.batch_id) for r in streams.late_view(spark, target, schema).collect()}


def test_late_rows_go_to_a_table_beside_the_mart(spark, tmp_path):
    """Every row is in the mart or in the late table, also when a batch is replayed."""
    path, target = tmp_path / "bronze", f"{tmp_path}/t"
    arrivals = [
        [complaint("1", "2024-01-10T10:00:00"), complaint("2", "2024-01-08T10:00:00")],  # the first batch has no horizon
        [complaint("3", "2024-01-09T00:00:00"), complaint("4", "2024-01-08T23:59:59"), complaint("5", "2024-01-10T00:00:00")],
        [complaint("6", "2024-01-20T00:00:00")],
        [complaint("7", "2024-01-18T23:59:59"), complaint("8", "2024-01-19T00:00:00"), complaint("9", "2024-01-20T01:00:00")],
    ]
    for i, rows in enumerate(arrivals):
        put(path, f"p{i}.json", *rows)
        timed = F.when(F.col("complaint_id") != "5", F.col("created_date"))  # one that lost its time
        streams.split_daily(stream(spark, path).withColumn("created_date", timed), target, f"{tmp_path}/c").awaitTermination()
    schema = stream(spark, path).schema
    want = {"4": ("late", 1), "5": ("no_time", 1), "7": ("late", 3)}
    assert late_ids(spark, target, schema) == want
    daily = streams.split_daily_view(spark, target)
    expected = marts.daily_complaints(batch(spark, path).filter(~F.col("complaint_id").isin(*want)))
    assert sorted(daily.collect()) == sorted(expected.select(daily.columns).collect())
    counts = {r.batch_id: r["count"] for r in spark.read.parquet(f"{target}/marks").groupBy("batch_id").count().collect()}
    assert counts == {0: 1, 1: 1, 2: 1, 3: 1}


def test_a_replayed_split_repeats_itself(spark, tmp_path):
    path, target = tmp_path / "bronze", f"{tmp_path}/t"
    put(path, "p0.json", complaint("1", "2024-01-10T10:00:00"))
    streams.split_daily(stream(spark, path), target, f"{tmp_path}/c").awaitTermination()
    put(path, "p1.json", complaint("2", "2024-01-02T10:00:00"), complaint("3", "2024-02-02T10:00:00"))
    streams.split_daily(stream(spark, path), target, f"{tmp_path}/c").awaitTermination()
    schema = stream(spark, path).schema
    before = late_ids(spark, target, schema), sorted(streams.split_daily_view(spark, target).collect())
    for commit in (tmp_path / "c" / "commits").glob("*1*"):  # as if the driver had died before the last commit
        commit.unlink()
    streams.split_daily(stream(spark, path), target, f"{tmp_path}/c").awaitTermination()
    assert (late_ids(spark, target, schema), sorted(streams.split_daily_view(spark, target).collect())) == before
    assert before[0] == {"2": ("late", 1)}


def test_event_time_days_are_cut_in_utc(spark, tmp_path):
    path = tmp_path / "bronze"
    put(path, "p0.json", complaint("1", "2024-03-10T00:00:00"), complaint("2", "2024-03-10T23:59:59"))
    rows = streams.run_daily(stream(spark, path)).collect()
    assert [(r.complaint_date, r.total_complaints) for r in rows] == [(datetime(2024, 3, 10).date(), 2)]
