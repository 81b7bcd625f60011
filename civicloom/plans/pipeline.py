"""End-to-end plans: build the layers, gate them, publish them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from civicloom import rules
from civicloom.operators import gates, marts, silver as silver_layer
from civicloom.operators.gates import GateContext
from civicloom.session import stage_path
from civicloom.sources.sinks import append_gate_log, export_gold, materialize, read_gate_log


def build_gold(
    raw: DataFrame,
    macro: DataFrame,
    ctx: GateContext,
    directory: str,
    tie_breakers: Sequence[str] = (),
    mode: str = "month",
    on_bad: str = "raise",
    within: Sequence[str] = (),
) -> DataFrame:
    """Bronze to stored silver to exported gold; returns the export manifest.

    Silver and the wide macro table are written once and every mart reads them back
    with only its own columns.
    """
    spark = raw.sparkSession
    materialize(silver_layer.stage_complaints(raw, tie_breakers, on_bad, within), f"{directory}/silver/complaints")
    materialize(macro, f"{directory}/silver/macro_wide")
    silver = spark.read.parquet(f"{directory}/silver/complaints")
    wide = spark.read.parquet(f"{directory}/silver/macro_wide")
    return export_gold(
        {
            "daily_complaints": marts.daily_complaints(silver),
            "borough_summary": marts.borough_summary(silver),
            "anomaly_summary": marts.anomaly_summary(silver),
            "resolution_anomalies": marts.resolution_anomalies(silver),
            "macro_daily": wide,
            "property_incidents": marts.property_incidents(silver, wide, mode),
            "address_risk_score": marts.address_risk_score(silver, ctx.now),
        },
        f"{directory}/gold",
        partition_by={"resolution_anomalies": ["complaint_year"], "anomaly_summary": ["complaint_year"]},
    )


@dataclass(frozen=True)
class GateConfig:
    """What to check on one asset; the defaults are the defaults of each gate."""

    contract: Mapping[str, str] = field(default_factory=dict)
    critical: Sequence[str] | None = None
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    null_warn: float = 0.02
    null_fail: float = 0.10
    max_age_hours: float = 6
    quarantine_warn: float = 0.05
    attrition: float = 0.15
    aggregated: bool = False
    soft_mb: float = 500.0
    hard_mb: float = 1500.0
    bytes_per_row: float = 256.0
    export_path: str | None = None
    whitelist: Sequence[str] = ()
    sample: float | None = None
    has_quarantine: bool = True


# The configuration of the daily mart.
DAILY_CONFIG = GateConfig(
    contract={
        "complaint_date": "DATE", "borough": "VARCHAR", "total_complaints": "BIGINT", "closed_complaints": "BIGINT",
        "open_complaints": "BIGINT", "avg_resolution_days": "DOUBLE", "anomaly_count": "BIGINT",
    },
    critical=["complaint_date", "borough", "total_complaints"],
    ranges={"total_complaints": (0, 1_000_000)},
    aggregated=True,
    soft_mb=100.0,
    hard_mb=500.0,
)


@dataclass(frozen=True)
class Layers:
    """The tables of one asset; None stands for a table that does not exist."""

    gold: DataFrame | None
    silver: DataFrame | None = None
    bronze: DataFrame | None = None
    quarantine: DataFrame | None = None
    reports: DataFrame | None = None


def logged_failures(
    spark: SparkSession, ctx: GateContext, checks: Mapping[str, Callable[[], DataFrame]]
) -> DataFrame:
    """The gates' rows, each evaluated on its own: one that cannot run is a ``fail`` row with its error.

    A gate is one row, so holding the rows costs nothing.
    """
    results = []
    for gate, check in checks.items():
        try:
            found = check()
            rows = spark.createDataFrame(found.collect(), found.schema)
        except PySparkException as error:
            reason = error.getCondition() or type(error).__name__
            rows = gates.fixed_result(spark, gate, ctx, gates.outcome("fail", f"the gate could not run: {reason}"))
        results.append(rows)
    return reduce(DataFrame.unionByName, results)


def measured_layers(spark: SparkSession, layers: Layers, config: GateConfig, ctx: GateContext) -> DataFrame:
    """All that the gates count, as one row: each layer is scanned once, all of them in one job."""
    gold, count = layers.gold, F.count(F.lit(1))
    parts = []
    if gold is not None:
        measures = gates.data_quality_measures(gold, config.critical, {c: r for c, r in config.ranges.items() if c in gold.columns})
        texts = gates.text_columns(gold, config.whitelist) if config.sample is None else []
        scanned = {c: gates.sensitive_kind(F.col(f"`{c}`")) for c in texts}
        # The kind of a value is worked out once for all counts of its column.
        rows = gold.withColumns({f"kind_of_{i}": kind for i, kind in enumerate(scanned.values())})
        hits = [
            gates.count_where(F.col(f"kind_of_{i}") == kind).alias(f"hits_{i}_{kind}")
            for i in range(len(texts)) for kind in rules.SENSITIVE_VALUE_PATTERNS
        ]
        parts.append(rows.agg(count.alias("gold"), count.alias("rows"), *measures, *hits))
        if config.export_path is not None:
            parts.append(gates.stored_bytes(spark, config.export_path))
    others = {"silver": layers.silver, "bronze": layers.bronze, "quarantine": layers.quarantine}
    parts += [df.agg(count.alias(name)) for name, df in others.items() if df is not None]
    if layers.reports is not None:
        parts.append(layers.reports.agg(*gates.validation_measures(ctx.asset)))
    nothing = {name: F.lit(None).cast("bigint") for name in ("gold", *others)}
    parts.append(spark.range(1).select(*[value.alias(name) for name, value in nothing.items()]))
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = merged.agg(*[F.max(c).alias(c) for c in merged.columns])
    return spark.createDataFrame(row.collect(), row.schema)


def _checks(
    spark: SparkSession, layers: Layers, config: GateConfig, ctx: GateContext, measured: DataFrame | None
) -> dict[str, Callable[[], DataFrame]]:
    gold = layers.gold

    def absent(gate: str) -> DataFrame:
        message = f"table {ctx.asset} does not exist"
        return gates.fixed_result(spark, gate, ctx, gates.outcome("fail", message))

    return {
        "schema": lambda: gates.schema_gate(spark, gold, ctx, config.contract),
        "data_quality": lambda: absent("data_quality") if gold is None else gates.data_quality_gate(
            gold, ctx, config.critical, config.ranges, config.null_warn, config.null_fail, measured
        ),
        "validation": lambda: gates.validation_gate(spark, layers.reports, ctx, config.max_age_hours, measured),
        "quarantine": lambda: gates.quarantine_gate(
            spark, gold, layers.silver, layers.quarantine, ctx, config.quarantine_warn,
            config.aggregated, config.has_quarantine, measured,
        ),
        "reconciliation": lambda: gates.reconciliation_gate(
            spark, gold, layers.silver, layers.bronze, ctx, config.attrition, config.aggregated, measured
        ),
        "cost": lambda: absent("cost") if gold is None else gates.cost_gate(
            gold, ctx, config.soft_mb, config.hard_mb, config.bytes_per_row, config.export_path, measured
        ),
        "security": lambda: gates.security_gate(
            spark, gold, ctx, config.whitelist, config.sample, measured if config.sample is None else None
        ),
    }


def required_gates(spark: SparkSession, layers: Layers, config: GateConfig, ctx: GateContext) -> DataFrame:
    """The seven required gates as seven rows.

    All are judged from one row of shared counts. Only if those can't be taken, or a gate can't be judged
    by them, is each gate run on its own, so that the one that fails says so and the
    others keep their results.
    """
    try:
        checks = _checks(spark, layers, config, ctx, measured_layers(spark, layers, config, ctx))
        rows = reduce(DataFrame.unionByName, [check() for check in checks.values()])
        return spark.createDataFrame(rows.collect(), rows.schema)
    except PySparkException:
        return logged_failures(spark, ctx, _checks(spark, layers, config, ctx, None))


def run_gates(
    spark: SparkSession, layers: Layers, config: GateConfig, ctx: GateContext, log_path: str | None = None
) -> DataFrame:
    """Run the seven gates, log them, then log the promotion verdict over what was logged.

    Returns this run's rows of the log. The verdict reads the rows written just
    before it, so it can never see a run half logged.
    """
    if not ctx.run_id:
        raise ValueError("gates need a run id")
    path = log_path or stage_path(spark, "gate_log")
    append_gate_log(gates.as_log_rows(required_gates(spark, layers, config, ctx)), path)
    verdict = gates.promotion_gate(read_gate_log(spark, path), ctx)
    append_gate_log(gates.as_log_rows(verdict), path)
    return read_gate_log(spark, path).filter(
        (F.col("run_id") == ctx.run_id) & (F.col("asset_name") == ctx.asset)
    )
