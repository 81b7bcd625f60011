"""Read-outs of the gate log: latest run, verdicts, grid, timeline, one run in detail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from civicloom import rules, schemas
from civicloom.functions.columns import count_where
from civicloom.operators.gates import latest_status

GATES = [*rules.REQUIRED_GATES, rules.PROMOTION_GATE, rules.FORECAST_GATE]


def run_timeline(log: DataFrame) -> DataFrame:
    """Per run: first time, status counts, distinct assets, rows."""
    return log.groupBy("run_id").agg(
        F.min("executed_at").alias("executed_at"),
        *[count_where(F.col("status") == s).alias(f"n_{s}") for s in ("pass", "warn", "fail")],
        F.countDistinct("asset_name").alias("n_assets"),
        F.count("gate_name").alias("n_gates"),
    )


def latest_run(log: DataFrame) -> DataFrame:
    """One row: the run that logged last."""
    return (
        log.groupBy("run_id")
        .agg(F.max("executed_at").alias("last_at"))
        .orderBy(F.col("last_at").desc_nulls_last(), F.desc("run_id"))
        .limit(1)
    )


def _in_latest_run(log: DataFrame) -> DataFrame:
    return log.join(F.broadcast(latest_run(log).select("run_id")), "run_id")  # one row


def latest_run_summary(log: DataFrame) -> DataFrame:
    """Status counts of the latest run, taken from one pass over the log."""
    return (
        log.groupBy("run_id")
        .agg(
            F.max("executed_at").alias("last_at"),
            *[count_where(F.col("status") == s).alias(f"n_{s}") for s in ("pass", "warn", "fail")],
        )
        .orderBy(F.col("last_at").desc_nulls_last(), F.desc("run_id"))
        .limit(1)
        .drop("last_at")
    )


def promotion_verdicts(log: DataFrame) -> DataFrame:
    """Promotion rows of the latest run."""
    return (
        _in_latest_run(log)
        .filter(F.col("gate_name") == rules.PROMOTION_GATE)
        .select("asset_name", F.upper("status").alias("verdict"), "message")
    )


def gate_grid(log: DataFrame, gates: Sequence[str] = tuple(GATES)) -> DataFrame:
    """Assets by gates, each cell the newest status.

    The listed gates are columns in that order; any other gate is an entry of the map
    ``other_gates``, so that the columns don't depend on the log and no result is lost.
    """
    newest = latest_status(log, ["asset_name", "gate_name"])
    cells = [F.max(F.when(F.col("gate_name") == gate, F.col("status"))).alias(gate) for gate in gates]
    entry = F.when(~F.col("gate_name").isin(*gates), F.struct("gate_name", "status"))
    others = F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("other_gates")
    return newest.groupBy("asset_name").agg(*cells, others)


def run_detail(log: DataFrame, run_id: str) -> DataFrame:
    """Every result of one run, metrics parsed. A partitioned log reads one partition."""
    rows = log.filter(F.col("run_id") == run_id)
    return rows.withColumn("parsed", F.from_json("metrics", schemas.GATE_METRICS)).select(
        "asset_name", "gate_name", "status", "message", "executed_at", "metrics",
        "parsed.record_count", "parsed.threshold_value", "parsed.actual_value", "parsed.details",
    )
