import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from civicloom import schemas, session
from civicloom.operators import silver
from civicloom.session import clear_stage, shared_dir, stage_table
from civicloom.sources import increments, json_arrays, readers, sinks


def write(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload))


def test_json_union_by_name_skips_malformed(spark, tmp_path):
    write(tmp_path / "a.json", [{"unique_key": "1", "borough": "x"}, {"unique_key": "2", "extra": 1}])
    write(tmp_path / "b.json", [{"unique_key": "3", "status": "Open"}])
    write(tmp_path / "c.json", '[{"unique_key": "4",')
    df = readers.read_json_bronze(spark, f"{tmp_path}/*.json", schemas.BRONZE_COMPLAINT)
    assert df.count() == 3
    assert {r.unique_key: r.status for r in df.collect()} == {"1": None, "2": None, "3": "Open"}
    assert df.columns == schemas.BRONZE_COMPLAINT.fieldNames()


def test_series_from_file_name(spark, tmp_path):
    write(tmp_path / "UNRATE_20240105.json", {"observations": [{"date": "2024-01-01", "value": "3.7"}]})
    write(tmp_path / "GDP_20240105.json", {"observations": [{"date": "2024-01-01", "value": "."}]})
    df = readers.with_series_from_filename(
        readers.read_json_bronze(spark, f"{tmp_path}/*.json", schemas.BRONZE_MACRO)
    )
    assert {r.series_id: r.source_file for r in df.collect()} == {
        "UNRATE": "UNRATE_20240105.json", "GDP": "GDP_20240105.json",
    }
    rows = silver.stage_observations(df, [F.desc("source_file")]).collect()
    assert [(r.series_id, r.value) for r in rows] == [("UNRATE", 3.7)]


def test_optional_and_tabular(spark, tmp_path):
    assert readers.read_optional(spark, f"{tmp_path}/nothing") is None
    spark.range(3).write.parquet(f"{tmp_path}/t")
    assert readers.read_optional(spark, f"{tmp_path}/t").count() == 3
    write(tmp_path / "x.csv", "a,b\n1,y\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert readers.read_tabular(spark, f"{tmp_path}/x.csv", schema).first() == (1, "y")
    assert readers.read_tabular(spark, f"{tmp_path}/t").count() == 3
    with pytest.raises(ValueError):
        readers.read_tabular(spark, f"{tmp_path}/x.csv")


def test_marks_are_not_compared_as_text(spark, tmp_path):
    increments.write_mark(spark, f"{tmp_path}/m", "999")
    increments.write_mark(spark, f"{tmp_path}/m", "1000")
    assert increments.read_mark(spark, f"{tmp_path}/m") == "1000"


def test_rows_split_three_ways_and_late_ones_are_held(spark, tmp_path):
    rows = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, ts int")
    parts = [increments.increment(rows, "ts", "10"), increments.late_rows(rows, "ts", "10"), increments.untimed_rows(rows, "ts")]
    assert [[r.id for r in p.collect()] for p in parts] == [[2], [1], [3]]
    paths = dict(state_path=f"{tmp_path}/s", target=f"{tmp_path}/t", quarantine=f"{tmp_path}/q", keys=["id"])
    increments.ingest_increment(rows, ts_col="ts", default_mark="0", **paths)
    grown = rows.union(spark.createDataFrame([(4, 5), (5, 30)], "id int, ts int"))
    second = increments.ingest_increment(grown, ts_col="ts", default_mark="0", **paths)
    assert (second["rows"], second["held"]) == (1, 1)
    again = increments.ingest_increment(grown, ts_col="ts", default_mark="0", **paths)
    assert (again["rows"], again["held"]) == (0, 0)
    held = {(r.id, r.reason) for r in spark.read.parquet(f"{tmp_path}/q").collect()}
    assert held == {(3, "no_time"), (4, "late")}
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {1, 2, 5}


def test_malformed_documents_are_counted(spark, tmp_path):
    write(tmp_path / "j" / "a.json", '[{"a": "1"}, {"a": "2"}]')
    write(tmp_path / "j" / "b.json", '[{"a": ')
    schema = T.StructType([T.StructField("a", T.StringType())])
    got = {r.source_file: (r.documents, r.malformed) for r in readers.malformed_json(spark, f"{tmp_path}/j", schema).collect()}
    assert got == {"a.json": (2, 0), "b.json": (0, 1)}


AWKWARD = ['}', '{"', '\\"}, {', "[", "a\\\\", "", "é}\n{", '"', '\\\\"}']


def awkward_objects(count):
    return [
        {"id": i, "note": AWKWARD[i % len(AWKWARD)] * (i % 5), "inner": {"list": [{"x": i}, {"y": {}}, [[]]], "text": AWKWARD[(i * 7) % len(AWKWARD)]}}
        for i in range(count)
    ]


@pytest.mark.parametrize("split", [400, 10_000_000])
@pytest.mark.parametrize("indent, ascii_only", [(None, True), (2, False)])
def test_large_arrays_are_split(spark, tmp_path, split, indent, ascii_only):
    """Arrays cut anywhere, in the middle of strings and of nested objects too, against a parser of the whole."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        objects = awkward_objects(100)
        write(tmp_path / "j" / "a.json", json.dumps(objects, indent=indent, ensure_ascii=ascii_only))
        write(tmp_path / "j" / "b.json", "\n ,".join(json.dumps(o) for o in objects[:30]))
        write(tmp_path / "j" / "c.json", json.dumps({"id": 7, "list": list("}{" * 300)}))
        write(tmp_path / "j" / "d.json", "[ ]")
        write(tmp_path / "j" / "e.json", json.dumps(objects)[:3000])
        rows = json_arrays.array_objects(spark, f"{tmp_path}/j").collect()
        if split == 400:
            assert json_arrays._pieces(spark, f"{tmp_path}/j").rdd.getNumPartitions() > 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    found = {}
    for r in rows:
        found.setdefault(r.file[-6], []).append(r.text)
    parsed = {name: sorted((json.loads(t) for t in texts), key=lambda o: o["id"]) for name, texts in found.items() if name in "abc"}
    assert parsed == {"a": objects, "b": objects[:30], "c": [{"id": 7, "list": list("}{" * 300)}]}
    assert "d" not in found and len(found["e"]) >= 5


def test_array_rows_and_malformed_objects(spark, tmp_path):
    write(tmp_path / "a.json", '[{"unique_key": "1", "borough": "x}"}, {"unique_key": nothing}, {"unique_key": "3", "extra": {"a": []}}, {"unique')
    df = json_arrays.read_json_arrays(spark, f"{tmp_path}/a.json", schemas.BRONZE_COMPLAINT)
    assert {r.unique_key: r.borough for r in df.collect()} == {"1": "x}", "3": None}
    assert df.columns == schemas.BRONZE_COMPLAINT.fieldNames()


def test_exports_are_verified_by_content(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, 0.1, "a", None), (2, float("nan"), "b|c", [1]), (3, None, None, []), (4, -1e300, "", [2, 3]), (5, float("inf"), "x", None)],
        "id int, v double, s string, l array<int>",
    )
    manifest = sinks.export_gold({"a": rows, "empty": rows.limit(0), "folders": rows}, f"{tmp_path}/gold", {"folders": ["id"]})
    checked = {r.table_name: r for r in sinks.verify_export(manifest).collect()}
    assert all(r.verified and r.row_count == r.found_rows for r in checked.values()) and checked["empty"].checksum == 0
    again = sinks.export_gold({"a": rows.orderBy(F.desc("id")).select("s", "l", "v", "id")}, f"{tmp_path}/again").first()
    assert again.checksum == checked["a"].checksum  # neither order counts
    sinks.materialize(rows.withColumn("v", F.when(F.col("id") == 1, 0.1001).otherwise(F.col("v"))), f"{tmp_path}/gold/a")
    verified = {r.table_name: r.verified for r in sinks.verify_export(manifest).collect()}
    assert verified == {"a": False, "empty": True, "folders": True}


def test_export_manifest(spark, tmp_path):
    manifest = sinks.export_gold({"a": spark.range(5), "b": spark.range(0)}, f"{tmp_path}/gold")
    assert {r.table_name: r.row_count for r in manifest.collect()} == {"a": 5, "b": 0}
    assert list((tmp_path / "gold" / "a").glob("*.zstd.parquet"))
    by_year = spark.range(90).withColumn("year", F.when(F.col("id") % 3 == 0, 2020).otherwise(F.col("id") % 5 + 2021))
    manifest = sinks.export_gold({"c": by_year}, f"{tmp_path}/gold", {"c": ["year"]})
    assert manifest.first().row_count == 90
    assert {p.name for p in (tmp_path / "gold" / "c").glob("year=*")} == {f"year={y}" for y in range(2020, 2026)}
    assert spark.read.parquet(f"{tmp_path}/gold/c").filter("year = 2020").count() == 30
    with pytest.raises(ValueError, match="missing gold tables: c"):
        sinks.export_gold({"a": spark.range(5), "c": None}, f"{tmp_path}/other")
    assert not (tmp_path / "other").exists()


def test_replace_run_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/forecast"
    sinks.replace_run(spark.range(3), path, "r1")
    sinks.replace_run(spark.range(2), path, "r2")
    sinks.replace_run(spark.range(4), path, "r1")
    sinks.replace_run(spark.range(4), path, "r1")
    counts = {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert counts == {"r1": 4, "r2": 2}
    sinks.replace_run(spark.range(0), path, "r1")
    assert {r.run_id for r in spark.read.parquet(path).collect()} == {"r2"}


def test_gate_log_appends(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert sinks.read_gate_log(spark, path).count() == 0
    row = spark.createDataFrame(
        [("r1", "a", "schema", "pass", "m", "{}", datetime(2024, 1, 1))],
        T.StructType([f for f in schemas.GATE_LOG.fields if f.name != "logged_at"]),
    )
    sinks.append_gate_log(row, path)
    sinks.append_gate_log(row, path)
    log = sinks.read_gate_log(spark, path)
    assert log.count() == 2 and log.filter("logged_at IS NULL").count() == 0


def test_materialize_and_sorted(spark, tmp_path):
    sinks.materialize(spark.range(3), "full_refresh_table")
    sinks.materialize(spark.range(2), "full_refresh_table")
    assert spark.table("full_refresh_table").count() == 2
    sinks.write_sorted(spark.range(100), f"{tmp_path}/sorted", [F.desc("id")])
    sinks.materialize(spark.range(4).withColumn("p", F.col("id") % 2), f"{tmp_path}/parts", ["p"])
    sinks.materialize(spark.range(1).withColumn("p", F.col("id") % 2), f"{tmp_path}/parts", ["p"])
    assert spark.read.parquet(f"{tmp_path}/parts").count() == 1
    ids = [r.id for r in spark.read.parquet(f"{tmp_path}/sorted").withColumn("f", F.input_file_name()).orderBy("f").collect()]
    assert sorted(ids, reverse=True) == list(range(99, -1, -1))


def test_findings_as_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([("t", ["a", "b"])], "table_name string, codes array<string>")
    sinks.write_findings(df, f"{tmp_path}/out")
    assert spark.read.option("header", True).schema("table_name string, codes string").csv(
        f"{tmp_path}/out/csv"
    ).first().codes == '["a","b"]'
    assert spark.read.schema(df.schema).json(f"{tmp_path}/out/json").first().codes == ["a", "b"]


def events(spark, *stamps):
    return spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, s string").select(
        "id", F.col("s").cast("timestamp_ntz").alias("ts")
    )


def test_increment_is_strict_and_advances(spark, tmp_path):
    state, target = f"{tmp_path}/state", f"{tmp_path}/bronze"
    first = increments.ingest_increment(
        events(spark, "2019-01-01", "2021-01-01", "2021-01-02"), state, "ts", target
    )
    assert (first["rows"], first["from_mark"]) == (2, "2020-07-29T19:21:00.000")
    grown = events(spark, "2019-01-01", "2021-01-01", "2021-01-02", "2021-01-02", "2021-02-01")
    second = increments.ingest_increment(grown, state, "ts", target)
    assert second["rows"] == 1 and second["from_mark"] == first["to_mark"]
    third = increments.ingest_increment(grown, state, "ts", target)
    assert third["rows"] == 0 and third["to_mark"] == second["to_mark"]
    assert spark.read.parquet(target).count() == 3
    assert increments.late_rows(grown, "ts", second["to_mark"]).count() == 5


def test_increment_repeats_safely_when_the_mark_was_not_saved(spark, tmp_path):
    target = f"{tmp_path}/bronze"
    source = events(spark, "2021-01-01", "2021-01-02")
    for attempt in ("lost", "kept"):
        increments.ingest_increment(source, f"{tmp_path}/{attempt}", "ts", target)
    assert spark.read.parquet(target).count() == 2


def test_two_increments_equal_one(spark, tmp_path):
    everything = events(spark, *[f"2022-01-{d:02d}" for d in range(1, 21)])
    early = everything.filter("ts <= '2022-01-07'")
    for source in (early, everything):
        increments.ingest_increment(source, f"{tmp_path}/s2", "ts", f"{tmp_path}/two")
    increments.ingest_increment(everything, f"{tmp_path}/s1", "ts", f"{tmp_path}/one")
    two, one = (sorted(r.id for r in spark.read.parquet(f"{tmp_path}/{n}").collect()) for n in ("two", "one"))
    assert two == one == list(range(20))


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage_table(spark.range(3), "unit")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_dir(spark) in name for name in staged.inputFiles())


def test_clear_stage_deletes_only_this_application(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    (tmp_path / "other-app").mkdir()
    stage_table(spark.range(3), "unit")
    assert len(list(tmp_path.iterdir())) == 2
    clear_stage(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["other-app"]


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_a_cluster_must_name_its_folder(master):
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"applicationId": "app"})

    Session.sparkContext.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
