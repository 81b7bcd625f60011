import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from civicloom import rules, schemas
from civicloom.operators import gates
from civicloom.operators.gates import GateContext
from civicloom.plans import pipeline
from civicloom.plans.pipeline import DAILY_CONFIG, Layers, run_gates
from civicloom.sources.sinks import read_gate_log

NOW = datetime(2024, 6, 1, 12)
CTX = GateContext("gold.t", "r1", NOW)


def status(df):
    rows = df.collect()
    assert len(rows) == 1 and df.columns == gates.RESULT
    assert rows[0].asset_name == "gold.t" and rows[0].run_id == "r1" and rows[0].executed_at == NOW
    assert rows[0].message
    return rows[0].status


def result(df):
    return df.first()


# --- schema ---


def test_schema_outcomes(spark):
    df = spark.createDataFrame([], "d date, b string, n bigint")
    contract = {"d": "DATE", "b": "VARCHAR", "n": "BIGINT"}
    assert status(gates.schema_gate(spark, df, CTX, contract)) == "pass"
    assert status(gates.schema_gate(spark, df, CTX)) == "pass"
    assert status(gates.schema_gate(spark, None, CTX, contract)) == "fail"
    missing = result(gates.schema_gate(spark, df, CTX, {**contract, "x": "DATE"}))
    assert missing.status == "fail" and json.loads(missing.details)["missing_columns"] == ["x"]
    assert status(gates.schema_gate(spark, df, CTX, {**contract, "n": "integer"})) == "fail"
    extra = result(gates.schema_gate(spark, df, CTX, {"d": "date"}))
    assert extra.status == "warn" and json.loads(extra.details)["extra_columns"] == ["b", "n"]


# --- data quality ---


def nulls(spark, total, missing):
    return spark.range(total).select(
        F.when(F.col("id") >= missing, F.col("id")).alias("v"), F.lit(1).alias("w")
    )


@pytest.mark.parametrize("missing, want", [(0, "pass"), (19, "pass"), (20, "warn"), (99, "warn"), (100, "fail")])
def test_null_rate_bounds(spark, missing, want):
    row = result(gates.data_quality_gate(nulls(spark, 1000, missing), CTX))
    assert row.status == want and row.record_count == 1000 and row.actual_value == missing / 1000


def test_range_comes_before_nulls_and_null_is_in_range(spark):
    df = nulls(spark, 1000, 500)
    row = result(gates.data_quality_gate(df, CTX, ranges={"v": (0, 998)}))
    assert row.status == "fail" and row.threshold_value is None
    assert json.loads(row.details)["range_violations"] == [{"column": "v", "range": [0.0, 998.0], "violations": 1}]
    assert result(gates.data_quality_gate(df, CTX, ranges={"v": (0, 999)})).threshold_value == 0.10


def test_critical_columns_and_empty_table(spark):
    assert status(gates.data_quality_gate(nulls(spark, 10, 10), CTX, critical=["w"])) == "pass"
    assert status(gates.data_quality_gate(nulls(spark, 10, 0), CTX, ranges={"gone": (0, 1)})) == "fail"
    empty = result(gates.data_quality_gate(nulls(spark, 0, 0), CTX))
    assert empty.status == "fail" and empty.record_count == 0


def test_worst_column_is_the_first_of_equals(spark):
    df = spark.createDataFrame([(None, None, 1)], "b int, a int, c int")
    assert "column b " in result(gates.data_quality_gate(df, CTX)).message


def test_data_quality_scans_once(spark):
    df = gates.data_quality_gate(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), CTX, ranges={"l_tax": (0, 1)})
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


# --- validation ---


def reports(spark, *rows):
    data = [("gold.t", f"m{i}", verdict, "{}", NOW - timedelta(hours=age)) for i, (verdict, age) in enumerate(rows)]
    return spark.createDataFrame(data, schemas.VALIDATION_REPORT)


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("APPROVE", 1)], "pass"), ([("approve", 6)], "pass"), ([("APPROVE", 6.01)], "fail"), ([("Review", 1)], "warn"),
        ([("REJECT", 1)], "fail"), ([(None, 1)], "fail"), ([], "fail"), ([("APPROVE", 3), ("REVIEW", 1)], "warn"),
    ],
)
def test_validation(spark, rows, want):
    assert status(gates.validation_gate(spark, reports(spark, *rows), CTX)) == want


def test_validation_without_reports(spark):
    assert status(gates.validation_gate(spark, None, CTX)) == "fail"
    other = GateContext("gold.other", "r1", NOW)
    assert result(gates.validation_gate(spark, reports(spark, ("APPROVE", 1)), other)).status == "fail"


# --- quarantine and reconciliation ---


@pytest.mark.parametrize(
    "gold, silver, held, aggregated, want",
    [
        (95, 100, 5, False, "pass"), (94, 100, 6, False, "warn"), (94, 100, 5, False, "fail"), (100, 100, None, False, "pass"),
        (99, 100, None, False, "fail"), (0, 0, 0, False, "pass"), (200, 100, 5, False, "pass"),
        (1, 100, 5, True, "pass"), (1, 100, 6, True, "warn"), (1, 0, 6, True, "pass"), (1, 100, None, True, "pass"),
    ],
)
def test_quarantine(spark, gold, silver, held, aggregated, want):
    frames = [spark.range(gold), spark.range(silver), None if held is None else spark.range(held)]
    assert status(gates.quarantine_gate(spark, *frames, CTX, aggregated=aggregated)) == want


def test_quarantine_unconfigured_or_absent(spark):
    assert status(gates.quarantine_gate(spark, None, None, None, CTX, configured=False)) == "pass"
    assert status(gates.quarantine_gate(spark, spark.range(1), None, None, CTX)) == "fail"


@pytest.mark.parametrize(
    "gold, silver, bronze, aggregated, want",
    [
        (85, 90, 100, False, "pass"), (84, 90, 100, False, "warn"), (91, 90, 100, False, "fail"),
        (85, 101, 100, False, "fail"), (None, 1, 1, False, "fail"), (1, None, None, False, "pass"),
        (1, None, 100, False, "warn"), (0, 0, 0, False, "pass"), (5, 4, 3, True, "fail"), (9, 4, 5, True, "pass"),
    ],
)
def test_reconciliation(spark, gold, silver, bronze, aggregated, want):
    frames = [None if n is None else spark.range(n) for n in (gold, silver, bronze)]
    assert status(gates.reconciliation_gate(spark, *frames, CTX, aggregated=aggregated)) == want


# --- cost ---


@pytest.mark.parametrize("rows, want", [(4, "pass"), (8, "pass"), (9, "warn"), (16, "warn"), (17, "fail")])
def test_cost_bounds_are_strict(spark, rows, want):
    megabyte = 1024.0 * 1024.0
    row = result(gates.cost_gate(spark.range(rows), CTX, soft_mb=8, hard_mb=16, bytes_per_row=megabyte))
    assert row.status == want and row.actual_value == rows


def test_cost_measures_stored_files(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(f"{tmp_path}/t")
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("part-*"))
    row = result(gates.cost_gate(spark.read.parquet(f"{tmp_path}/t"), CTX, path=f"{tmp_path}/t"))
    assert row.record_count == 1000 and row.actual_value == pytest.approx(size / 1024 / 1024)


# --- security ---


def test_sensitive_names():
    found = gates.sensitive_names(["SSN", "a_ssn", "user_api_key", "dob", "borough", "token_count", "my_secret"], ["my_secret"])
    assert set(found) == {"SSN", "user_api_key", "dob"}


def test_security_names_stop_the_scan(spark):
    df = spark.createDataFrame([("a@b.co",)], "password string")
    row = result(gates.security_gate(spark, df, CTX))
    assert row.status == "fail" and "value_pattern_hits" not in row.details
    assert result(gates.security_gate(spark, df, CTX, whitelist=["password"])).status == "pass"


def test_security_values(spark):
    rows = [
        ("call 123-45-6789", 1), ("mail a.b+c@d-e.org now", 2), ("4111 1111 1111 1111", 3), ("4111-1111-1111-1", 4),
        ("123-45-6789 and a@b.co", 5), ("12345678901234567", 6), ("x123-45-67890", 7), (None, 8), ("a@b", 9),
    ]
    df = spark.createDataFrame(rows, "note string, n int")
    hits = {(r.column, r.kind): r.hits for r in gates.scan_sensitive(df).collect()}
    assert hits == {("note", "ssn"): 2, ("note", "email"): 1, ("note", "credit_card_16"): 2}
    row = result(gates.security_gate(spark, df, CTX))
    assert row.status == "warn" and len(json.loads(row.details)["value_pattern_hits"]) == 3
    assert status(gates.security_gate(spark, df.select("n"), CTX)) == "pass"
    assert status(gates.security_gate(spark, None, CTX)) == "fail"


def test_prefilters_do_not_hide_a_match(spark, sf):
    """Every pattern on every text, with and without the cheap tests in front."""
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("text")
    chain = F
    for kind, pattern in rules.SENSITIVE_VALUE_PATTERNS.items():
        chain = chain.when(F.col("text").rlike(pattern), kind)
    both = texts.select(gates.sensitive_kind(F.col("text")).alias("a"), chain.alias("b"))
    assert both.filter("NOT a <=> b").count() == 0 and both.filter("b IS NOT NULL").count() > 0


# --- promotion ---


def log(spark, statuses, **extra):
    rows = [("r1", "gold.t", g, s, "m", "{}", NOW, NOW) for g, s in {**statuses, **extra}.items()]
    rows.append(("r0", "gold.t", "schema", "fail", "m", "{}", NOW, NOW))
    return spark.createDataFrame(rows, schemas.GATE_LOG)


PASSING = {g: "pass" for g in rules.REQUIRED_GATES}


@pytest.mark.parametrize(
    "changes, want",
    [
        ({}, "pass"), ({"cost": "warn"}, "warn"), ({"cost": "warn", "schema": "fail"}, "fail"),
        ({"trend_forecast": "warn"}, "warn"), ({"promotion": "fail"}, "pass"),
    ],
)
def test_promotion(spark, changes, want):
    assert status(gates.promotion_gate(log(spark, PASSING, **changes), CTX)) == want


def test_promotion_needs_every_gate_and_a_run(spark):
    partial = {g: s for g, s in PASSING.items() if g not in ("cost", "schema")}
    row = result(gates.promotion_gate(log(spark, partial), CTX))
    assert row.status == "fail" and json.loads(row.details)["missing_gates"] == ["schema", "cost"]
    assert result(gates.promotion_gate(log(spark, PASSING), replace(CTX, run_id=None))).status == "fail"
    assert result(gates.promotion_gate(log(spark, PASSING), replace(CTX, run_id="none"))).status == "fail"


def test_newest_row_of_a_gate_counts(spark):
    older = ("r1", "gold.t", "cost", "fail", "m", "{}", NOW - timedelta(hours=1), NOW)
    rows = log(spark, PASSING).union(spark.createDataFrame([older], schemas.GATE_LOG))
    assert status(gates.promotion_gate(rows, CTX)) == "pass"
    by_run = {r.run_id: r.status for r in gates.promotion_by_run(rows).collect()}
    assert by_run == {"r1": "pass", "r0": "fail"}


# --- all gates, clean and broken ---


def complaints(spark):
    days = spark.range(60).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("complaint_date"))
    names = spark.createDataFrame([(b,) for b in rules.BOROUGHS], "borough string")
    many = spark.range(4).select(F.col("id").alias("n"))
    return days.join(names, F.lit(True)).join(many, F.lit(True)).withColumn("complaint_id", F.concat("borough", "complaint_date", "n"))


def test_clean_run_then_broken_run(spark, tmp_path):
    path = f"{tmp_path}/log"
    bronze = complaints(spark)
    held = bronze.filter("n = 0 AND day(complaint_date) = 1")
    silver = bronze.subtract(held)
    gold = daily_of(silver)
    layers = Layers(gold, silver, bronze, held, reports(spark, ("APPROVE", 1)))
    clean = {r.gate_name: r.status for r in run_gates(spark, layers, DAILY_CONFIG, CTX, path).collect()}
    assert clean == {**PASSING, "promotion": "pass"}

    broken = replace(layers, gold=gold.drop("borough"))
    second = replace(CTX, run_id="r2", now=NOW + timedelta(hours=1))
    states = {r.gate_name: r.status for r in run_gates(spark, broken, DAILY_CONFIG, second, path).collect()}
    assert states["schema"] == "fail" and states["promotion"] == "fail"
    assert read_gate_log(spark, path).count() == 16

    third = replace(CTX, run_id="r3")
    gone = {r.gate_name: r.status for r in run_gates(spark, replace(layers, gold=None), DAILY_CONFIG, third, path).collect()}
    assert gone["promotion"] == "fail" and gone["data_quality"] == "fail"


def test_shared_scans_judge_as_each_gate_does(spark):
    """The same rows, message and details included, from one row of counts and from a scan per gate."""
    bronze = complaints(spark)
    silver = bronze.filter("n > 0")
    gold = daily_of(silver).withColumn("note", F.concat_ws("@", F.lit("a"), F.lit("b.org")))
    layers = Layers(gold, silver, bronze, bronze.filter("n = 0"), reports(spark, ("APPROVE", 1), ("REVIEW", 9)))
    config = replace(DAILY_CONFIG, critical=None, soft_mb=1e-9)
    shared = pipeline._checks(spark, layers, config, CTX, pipeline.measured_layers(spark, layers, config, CTX))
    alone = pipeline._checks(spark, layers, config, CTX, None)
    for gate in alone:
        assert result(shared[gate]()) == result(alone[gate]()), gate
    assert result(shared["security"]()).status == "warn" and result(shared["cost"]()).status == "warn"
    some = Layers(gold)
    found = pipeline.required_gates(spark, some, config, CTX).collect()
    assert [r.gate_name for r in found] == list(alone) and found[2].status == "fail"


def test_each_layer_is_read_once(spark, tmp_path):
    layer = {}
    for name in ("gold", "silver", "bronze"):
        complaints(spark).write.parquet(f"{tmp_path}/{name}")
        layer[name] = spark.read.parquet(f"{tmp_path}/{name}")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("shared-gates", "")
    pipeline.required_gates(spark, Layers(layer["gold"], layer["silver"], layer["bronze"]), DAILY_CONFIG, CTX)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("shared-gates")) <= 6


def daily_of(silver):
    counts = {c: F.count(F.lit(1)) for c in ("total_complaints", "closed_complaints", "open_complaints", "anomaly_count")}
    daily = silver.groupBy("complaint_date", "borough").agg(*[n.alias(c) for c, n in counts.items()])
    return daily.withColumn("avg_resolution_days", F.lit(1.0))


def test_a_gate_that_cannot_run_is_logged(spark, tmp_path):
    silver = complaints(spark)
    gold = daily_of(silver).withColumn("note", F.lit("many"))
    layers = Layers(gold, silver, silver, silver.filter("false"), reports(spark, ("APPROVE", 1)))
    config = replace(DAILY_CONFIG, ranges={"note": (0, 1)})
    rows = {r.gate_name: r for r in run_gates(spark, layers, config, CTX, f"{tmp_path}/log").collect()}
    assert len(rows) == 8 and rows["promotion"].status == "fail"
    assert rows["data_quality"].status == "fail" and "could not run" in rows["data_quality"].message
    assert rows["cost"].status == rows["reconciliation"].status == "pass"


# --- constraints ---


def test_constraints(spark):
    df = spark.createDataFrame([("1", "A"), ("1", None), (None, "B"), (None, "Z"), ("2", "A")], "id string, b string")
    got = {(r.rule, r.column): r.failures for r in gates.check_constraints(df, ["id"], ["id", "b"], {"b": ["A", "B"]}).collect()}
    assert got == {("unique", "id"): 1, ("not_null", "id"): 2, ("not_null", "b"): 1, ("accepted_values", "b"): 1}
    with pytest.raises(ValueError):
        gates.check_constraints(df)
