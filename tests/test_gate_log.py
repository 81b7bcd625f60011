from datetime import datetime

import pytest

from civicloom import schemas
from civicloom.operators import gate_log, gates
from civicloom.sources.sinks import append_gate_log, read_gate_log


@pytest.fixture(scope="module")
def log(spark):
    rows = []

    def add(run, asset, gate, status, hour):
        at = datetime(2024, 1, 1, hour)
        rows.append((run, asset, gate, status, f"{gate} {status}", '{"record_count": 5, "actual_value": 0.5}', at, at))

    for run, hour, cost in (("a", 1, "fail"), ("b", 5, "warn")):
        for asset in ("x", "y"):
            add(run, asset, "schema", "pass", hour)
            add(run, asset, "cost", cost, hour + 1)
            add(run, asset, "promotion", cost, hour + 2)
    add("a", "z", "schema", "fail", 3)
    return spark.createDataFrame(rows, schemas.GATE_LOG)


def test_latest_run_summary(log):
    row = gate_log.latest_run_summary(log).first()
    assert (row.run_id, row.n_pass, row.n_warn, row.n_fail) == ("b", 2, 4, 0)


def test_verdicts_of_latest_run(log):
    assert sorted(gate_log.promotion_verdicts(log).collect()) == [("x", "WARN", "promotion warn"), ("y", "WARN", "promotion warn")]


def test_grid_holds_newest_status(log):
    grid = {r.asset_name: r for r in gate_log.gate_grid(log).collect()}
    assert grid["x"].cost == "warn" and grid["z"].schema == "fail" and grid["z"].cost is None
    assert set(gate_log.GATES) < set(grid["x"].asDict())
    few = {r.asset_name: r for r in gate_log.gate_grid(log, ["schema"]).collect()}
    assert few["x"].other_gates["cost"] == "warn" and "schema" not in few["x"].other_gates


def test_timeline(log):
    rows = {r.run_id: r for r in gate_log.run_timeline(log).collect()}
    a = rows["a"]
    assert (a.n_pass, a.n_warn, a.n_fail, a.n_assets, a.n_gates) == (2, 0, 5, 3, 7)
    assert a.executed_at == datetime(2024, 1, 1, 1)


def test_detail_parses_metrics(log):
    rows = gate_log.run_detail(log, "b").collect()
    assert len(rows) == 6 and rows[0].record_count == 5 and rows[0].actual_value == 0.5


def test_detail_reads_one_partition(spark, tmp_path, log):
    append_gate_log(log.drop("logged_at"), f"{tmp_path}/log")
    stored = read_gate_log(spark, f"{tmp_path}/log")
    plan = gate_log.run_detail(stored, "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan
    assert gates.promotion_by_run(stored).count() == 5
