"""Promotion gates. Each one is a single aggregation that yields one result row.

A result row has the columns of ``RESULT``. The first outcome whose condition holds
decides it, so every gate reads as its list of rules in order of evaluation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from civicloom import rules
from civicloom.functions.columns import count_where, timestamp_literal

RESULT = [
    "gate_name", "asset_name", "status", "message", "record_count", "threshold_value",
    "actual_value", "details", "run_id", "executed_at",
]


@dataclass(frozen=True)
class GateContext:
    """What every result row carries: the asset, the run and the time of the check."""

    asset: str
    run_id: str | None
    now: datetime


def _text(*parts: object) -> Column:
    """Concatenate text and columns; a NULL column prints as ``unknown``."""
    return F.concat(
        *[
            F.coalesce(p.cast("string"), F.lit("unknown")) if isinstance(p, Column) else F.lit(str(p))
            for p in parts
        ]
    )


def _percent(value: Column | float, digits: int = 2) -> Column:
    column = value if isinstance(value, Column) else F.lit(float(value))
    return F.format_string(f"%.{digits}f%%", column * 100.0)


def outcome(
    status: str,
    message: Column | str,
    record_count: Column | int | None = None,
    threshold: Column | float | None = None,
    actual: Column | float | None = None,
    details: Column | None = None,
) -> Column:
    def typed(value: object, kind: str) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast(kind)

    return F.struct(
        F.lit(status).alias("status"),
        typed(message, "string").alias("message"),
        typed(record_count, "bigint").alias("record_count"),
        typed(threshold, "double").alias("threshold_value"),
        typed(actual, "double").alias("actual_value"),
        typed(details, "string").alias("details"),
    )


def _result(
    row: DataFrame, gate: str, ctx: GateContext, cases: Sequence[tuple[Column, Column]], default: Column
) -> DataFrame:
    chosen = default
    if cases:
        first, *rest = cases
        chosen = reduce(lambda acc, case: acc.when(*case), rest, F.when(*first)).otherwise(default)
    return row.select(chosen.alias("o")).select(
        F.lit(gate).alias("gate_name"),
        F.lit(ctx.asset).alias("asset_name"),
        "o.status", "o.message", "o.record_count", "o.threshold_value", "o.actual_value", "o.details",
        F.lit(ctx.run_id).cast("string").alias("run_id"),
        timestamp_literal(ctx.now).alias("executed_at"),
    )


def fixed_result(spark: SparkSession, gate: str, ctx: GateContext, outcome: Column) -> DataFrame:
    """A result known from metadata alone."""
    return _result(spark.range(1), gate, ctx, [], outcome)


def layer_counts(spark: SparkSession, **layers: DataFrame | None) -> DataFrame:
    """One row with the row count of each layer; an absent layer counts NULL."""
    present = {name: df for name, df in layers.items() if df is not None}
    if not present:
        return spark.range(1).select(*[F.lit(None).cast("bigint").alias(name) for name in layers])
    rows = reduce(
        DataFrame.unionByName,
        [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n") for name, df in present.items()],
    )
    return rows.agg(
        *[F.max(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in layers]
    )


# --- Schema -----------------------------------------------------------------

# SQL type names a contract may use, by the Spark type they stand for.
TYPE_NAMES = {
    "VARCHAR": "string", "TEXT": "string", "STRING": "string", "BIGINT": "bigint",
    "LONG": "bigint", "INTEGER": "int", "INT": "int", "SMALLINT": "smallint",
    "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def _type_name(name: str) -> str:
    return TYPE_NAMES.get(name.upper(), name.lower())


def schema_gate(
    spark: SparkSession, df: DataFrame | None, ctx: GateContext, contract: Mapping[str, str] | None = None
) -> DataFrame:
    """Columns and types against a contract. Reads metadata only; no job runs."""
    def result(*args: object, **kwargs: object) -> DataFrame:
        return fixed_result(spark, "schema", ctx, outcome(*args, **kwargs))

    def as_json(**values: list[str]) -> Column:
        return F.to_json(F.struct(*[F.array(*map(F.lit, v)).alias(k) for k, v in values.items()]))

    if df is None:
        return result("fail", f"table {ctx.asset} does not exist")
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if not contract:
        return result("pass", f"{len(actual)} columns, no contract to compare with", len(actual))
    missing = [c for c in contract if c not in actual]
    if missing:
        return result(
            "fail", f"required columns are missing: {', '.join(missing)}",
            details=as_json(missing_columns=missing, actual_columns=list(actual)),
        )
    wrong = [
        f"{c} should be {kind} but is {actual[c]}" for c, kind in contract.items() if actual[c] != _type_name(kind)
    ]
    if wrong:
        return result("fail", f"types differ: {'; '.join(wrong)}", details=as_json(mismatches=wrong))
    extra = [c for c in actual if c not in contract]
    if extra:
        return result(
            "warn", f"columns outside the contract: {', '.join(extra)}", len(actual),
            details=as_json(extra_columns=extra),
        )
    return result("pass", f"{len(actual)} columns match the contract", len(actual))


# --- Data quality -----------------------------------------------------------


def _checked_columns(df: DataFrame, critical: Sequence[str] | None) -> list[str]:
    return [c for c in df.columns if not critical or c in critical]


def data_quality_measures(
    df: DataFrame, critical: Sequence[str] | None = None, ranges: Mapping[str, tuple[float, float]] | None = None
) -> list[Column]:
    """What the data-quality gate counts of a table."""
    nulls = [count_where(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(_checked_columns(df, critical))]
    outside = [
        count_where((F.col(f"`{c}`") < lo) | (F.col(f"`{c}`") > hi)).alias(f"range_{i}")
        for i, (c, (lo, hi)) in enumerate((ranges or {}).items())
    ]
    return [F.count(F.lit(1)).alias("total"), *nulls, *outside]


def data_quality_gate(
    df: DataFrame,
    ctx: GateContext,
    critical: Sequence[str] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    warn: float = 0.02,
    fail: float = 0.10,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Null rates and value ranges, every column counted in the same scan.

    ``measured`` is a row that holds the ``data_quality_measures`` already.
    """
    ranges = ranges or {}
    absent = [c for c in ranges if c not in df.columns]
    if absent:
        message = f"columns to check are missing: {', '.join(absent)}"
        return fixed_result(df.sparkSession, "data_quality", ctx, outcome("fail", message))
    columns = _checked_columns(df, critical)
    row = df.agg(*data_quality_measures(df, critical, ranges)) if measured is None else measured
    total = F.col("total")
    rates = [F.col(f"null_{i}").cast("double") / F.nullif(total, F.lit(0)) for i in range(len(columns))]
    rate_list = F.array(*rates) if rates else F.array().cast("array<double>")
    names = F.array(*map(F.lit, columns)) if columns else F.array().cast("array<string>")
    row = row.withColumn("rates", rate_list).withColumn(
        "worst", F.coalesce(F.array_max("rates"), F.lit(0.0))
    )
    # The first column to reach the worst rate names it, as a scan in column order would.
    worst_name = F.get(names, F.array_position("rates", F.col("worst")).cast("int") - 1)
    null_rates = F.map_from_arrays(names, F.transform("rates", lambda r: F.round(r, 5).cast("decimal(10,5)")))
    violations = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.array(F.lit(float(lo)), F.lit(float(hi))).alias("range"),
                    F.col(f"range_{i}").alias("violations"),
                )
                for i, (c, (lo, hi)) in enumerate(ranges.items())
            ]
        )
        if ranges
        else F.array().cast("array<struct<column:string,range:array<double>,violations:bigint>>"),
        lambda v: v["violations"] > 0,
    )
    row = row.select("total", "worst", worst_name.alias("name"), null_rates.alias("null_rates"), violations.alias("bad"))
    worst = F.col("worst")
    rates_json = F.to_json(F.struct("null_rates"))

    def over(status: str, limit: float) -> Column:
        return outcome(
            status, _text("column ", F.col("name"), " is ", _percent(worst), f" null, {status} limit ", _percent(limit)),
            total, limit, worst, rates_json,
        )

    return _result(
        row, "data_quality", ctx,
        [
            (total == 0, outcome("fail", "the table is empty", 0)),
            (
                F.size("bad") > 0,
                outcome(
                    "fail", _text(F.size("bad"), " columns have values out of range"), total,
                    details=F.to_json(F.struct(F.col("bad").alias("range_violations"), "null_rates")),
                ),
            ),
            (worst >= fail, over("fail", fail)),
            (worst >= warn, over("warn", warn)),
        ],
        outcome(
            "pass", _text(f"{len(columns)} columns checked, at most ", _percent(worst), " null"),
            total, actual=worst, details=rates_json,
        ),
    )


# --- Validation report ------------------------------------------------------


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / 3_600_000_000.0


def validation_measures(asset: str) -> list[Column]:
    """What the validation gate reads of the report table."""
    mine = F.col("asset_name") == asset
    return [
        count_where(mine).alias("reports"),
        F.max(F.when(mine, F.col("created_at"))).alias("created_at"),
        F.max_by("recommendation", F.when(mine, F.struct("created_at", "run_id"))).alias("recommendation"),
    ]


def validation_gate(
    spark: SparkSession, reports: DataFrame | None, ctx: GateContext, max_age_hours: float = 6, measured: DataFrame | None = None
) -> DataFrame:
    """The newest report of the asset must be fresh and must approve it. Times are UTC.

    ``measured`` is a row that holds the ``validation_measures`` already.
    """
    if reports is None:
        return fixed_result(spark, "validation", ctx, outcome("fail", "the report table does not exist"))
    newest = reports.filter(F.col("asset_name") == ctx.asset).agg(*validation_measures(ctx.asset)) if measured is None else measured
    row = newest.select(
        "reports",
        F.upper(F.coalesce("recommendation", F.lit(""))).alias("verdict"),
        hours_between(F.col("created_at"), timestamp_literal(ctx.now)).alias("age"),
    )
    verdict, age = F.col("verdict"), F.col("age")
    details = F.to_json(F.struct(verdict.alias("recommendation"), F.round(age, 2).cast("decimal(18,2)").alias("age_hours")))
    aged = F.format_string("%.1f h old", age)
    return _result(
        row, "validation", ctx,
        [
            (F.col("reports") == 0, outcome("fail", f"there is no validation report for {ctx.asset}")),
            (
                age > max_age_hours,
                outcome("fail", _text("the report is ", aged, f", limit {max_age_hours} h"), None, max_age_hours, age),
            ),
            (verdict == "APPROVE", outcome("pass", _text("report approves, ", aged), details=details)),
            (verdict == "REVIEW", outcome("warn", _text("report asks for review, ", aged), details=details)),
        ],
        outcome("fail", _text("report says ", verdict, ", ", aged), details=details),
    )


# --- Conservation of rows ---------------------------------------------------


def quarantine_gate(
    spark: SparkSession,
    gold: DataFrame | None,
    silver: DataFrame | None,
    quarantine: DataFrame | None,
    ctx: GateContext,
    warn: float = 0.05,
    aggregated: bool = False,
    configured: bool = True,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Silver rows must be in gold or in quarantine; the quarantined share stays low.

    An aggregated gold table cannot conserve rows, so only the share is checked.
    A quarantine table that does not exist counts zero rows. ``measured`` is a row that
    holds the ``layer_counts`` already.
    """
    if not configured:
        return fixed_result(spark, "quarantine", ctx, outcome("pass", "no quarantine set up, nothing to check"))
    if gold is None or silver is None:
        return fixed_result(spark, "quarantine", ctx, outcome("fail", "gold or silver table does not exist"))
    counts = layer_counts(spark, silver=silver, gold=gold, quarantine=quarantine) if measured is None else measured
    row = counts.withColumn("quarantine", F.coalesce("quarantine", F.lit(0)))
    in_silver, in_gold, held = F.col("silver"), F.col("gold"), F.col("quarantine")
    share = held.cast("double") / F.nullif(in_silver, F.lit(0))
    orphans = in_silver - in_gold - held
    layers = _text("silver ", in_silver, ", gold ", in_gold, ", quarantine ", held)
    mode = F.lit("aggregated" if aggregated else "row_level")
    details = F.to_json(
        F.struct("silver", in_gold.alias("gold_aggregated"), "quarantine", mode.alias("mode"))
        if aggregated
        else F.struct("silver", "gold", "quarantine")
    )
    cases = []
    if not aggregated:
        cases.append(
            (orphans > 0, outcome("fail", _text(orphans, " silver rows are unaccounted for: ", layers), None, 0, orphans, details))
        )
    cases += [
        (in_silver == 0, outcome("pass", "silver is empty")),
        (
            share > warn,
            outcome("warn", _text(_percent(share), " of silver is quarantined, limit ", _percent(warn)), None, warn, share, details),
        ),
    ]
    passed = outcome("pass", _text(_percent(share), " quarantined: ", layers), actual=share, details=details)
    return _result(row, "quarantine", ctx, cases, passed)


def reconciliation_gate(
    spark: SparkSession,
    gold: DataFrame | None,
    silver: DataFrame | None,
    bronze: DataFrame | None,
    ctx: GateContext,
    attrition: float = 0.15,
    aggregated: bool = False,
    measured: DataFrame | None = None,
) -> DataFrame:
    """No layer may hold more rows than the one below it, and few rows may be lost.

    ``measured`` is a row that holds the ``layer_counts`` already.
    """
    if gold is None:
        return fixed_result(spark, "reconciliation", ctx, outcome("fail", f"{ctx.asset} does not exist"))
    row = layer_counts(spark, bronze=bronze, silver=silver, gold=gold) if measured is None else measured
    raw, clean, final = F.col("bronze"), F.col("silver"), F.col("gold")
    lost = (raw - final).cast("double") / F.nullif(raw, F.lit(0))
    layers = _text("bronze ", raw, ", silver ", clean, ", gold ", final)
    mode = F.lit("aggregated" if aggregated else "row_level").alias("mode")
    details = F.to_json(F.struct("bronze", "silver", "gold", mode))
    grew = (clean > raw, outcome("fail", _text("silver outgrew bronze: ", layers), None, raw, clean, details))
    if aggregated:
        cases = [grew]
    else:
        cases = [
            (final > clean, outcome("fail", _text("gold outgrew silver: ", layers), None, clean, final, details)),
            grew,
            (
                (raw > 0) & (lost > attrition),
                outcome("warn", _text(_percent(lost, 1), " of bronze was lost: ", layers), None, attrition, lost, details),
            ),
        ]
    return _result(
        row, "reconciliation", ctx, cases, outcome("pass", _text("layers reconcile: ", layers), final, details=details)
    )


# --- Cost -------------------------------------------------------------------


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row ``bytes``: the size of all files under a path, from the file listing.

    The contents are not selected, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length").alias("bytes"))


def cost_gate(
    df: DataFrame,
    ctx: GateContext,
    soft_mb: float = 500.0,
    hard_mb: float = 1500.0,
    bytes_per_row: float = 256.0,
    path: str | None = None,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Size against budgets: the stored size when ``path`` is given, else rows times a guess.

    ``measured`` is a row that holds ``rows``, and ``bytes`` where a path is given, already.
    """
    if measured is None:
        measured = df.agg(F.count(F.lit(1)).alias("rows"))
        if path is not None:
            both = measured.unionByName(stored_bytes(df.sparkSession, path), allowMissingColumns=True)
            measured = both.agg(F.max("rows").alias("rows"), F.max("bytes").alias("bytes"))
    if path is None:
        row = measured.withColumn("size_mb", F.col("rows").cast("double") * bytes_per_row / 1024 / 1024)
        source = f"estimated at {bytes_per_row:g} bytes per row"
    else:
        row = measured.withColumn("size_mb", F.col("bytes").cast("double") / 1024 / 1024)
        source = f"measured at {path}"
    rows, size = F.col("rows"), F.col("size_mb")
    details = F.to_json(F.struct("rows", F.round(size, 2).cast("decimal(18,2)").alias("size_mb"), F.lit(source).alias("source")))
    shown = F.format_string("%.1f MB", size)

    def over(status: str, limit: float) -> Column:
        return outcome(status, _text(shown, f" is over {limit:g} MB, {source}"), None, limit, size, details)

    return _result(
        row, "cost", ctx,
        [(size > hard_mb, over("fail", hard_mb)), (size > soft_mb, over("warn", soft_mb))],
        outcome("pass", _text(shown, f" is within {soft_mb:g} MB"), rows, actual=size, details=details),
    )


# --- Security ---------------------------------------------------------------


def sensitive_names(columns: Sequence[str], whitelist: Sequence[str] = ()) -> dict[str, str]:
    """Column names that look sensitive, with the pattern each one matched."""
    found = {}
    for name in columns:
        if name in whitelist:
            continue
        hit = next((p for p in rules.SENSITIVE_NAME_PATTERNS if re.search(p, name.lower(), re.ASCII)), None)
        if hit:
            found[name] = hit
    return found


#: What any of the patterns needs: an at sign, or three digits with nothing but blanks and hyphens between.
_NEEDED = "@|[0-9](?:[ -]*[0-9]){2}"


def sensitive_kind(value: Column) -> Column:
    """Kind of sensitive text in a value; the first pattern that matches wins.

    One combined pattern is tried on every value, the others only where it is found. The e-mail pattern,
    which starts anew at each letter, also waits for an at sign.
    """
    possible = value.rlike(_NEEDED)
    cases = []
    for kind, pattern in rules.SENSITIVE_VALUE_PATTERNS.items():
        near = possible & F.contains(value, F.lit("@")) if "@" in pattern else possible
        cases.append((near & value.rlike(pattern), kind))
    (first, first_kind), *rest = cases
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(first, first_kind))


def text_columns(df: DataFrame, whitelist: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in whitelist]


def sensitive_measures(columns: Sequence[str]) -> list[Column]:
    """Hits per text column and kind."""
    kinds = {i: sensitive_kind(F.col(f"`{c}`")) for i, c in enumerate(columns)}
    return [count_where(kinds[i] == kind).alias(f"hits_{i}_{kind}") for i in kinds for kind in rules.SENSITIVE_VALUE_PATTERNS]


def _sensitive_hits(columns: Sequence[str]) -> Column:
    """The measures as a list of (column, kind, hits) that were met."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(f"hits_{i}_{kind}").alias("hits"))
        for i, c in enumerate(columns) for kind in rules.SENSITIVE_VALUE_PATTERNS
    ]
    return F.filter(F.array(*entries), lambda e: e["hits"] > 0)


def scan_sensitive(
    df: DataFrame, columns: Sequence[str] | None = None, sample: float | None = None
) -> DataFrame:
    """(column, kind, hits) for text columns. Scans every value unless asked to sample."""
    if columns is None:
        columns = text_columns(df)
    if sample is not None:
        df = df.sample(sample, seed=0)
    # The kind of a value is a column of its own, so that it is worked out once for all counts.
    kinds = df.select(*[sensitive_kind(F.col(f"`{c}`")).alias(f"k{i}") for i, c in enumerate(columns)])
    counts = kinds.agg(*[
        count_where(F.col(f"k{i}") == kind).alias(f"hits_{i}_{kind}")
        for i in range(len(columns)) for kind in rules.SENSITIVE_VALUE_PATTERNS
    ])
    return counts.select(F.explode(_sensitive_hits(columns)).alias("e")).select("e.*")


def security_gate(
    spark: SparkSession,
    df: DataFrame | None,
    ctx: GateContext,
    whitelist: Sequence[str] = (),
    sample: float | None = None,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Sensitive column names fail at once; sensitive values ask for a look.

    ``measured`` is a row that holds the ``sensitive_measures`` of the text columns already.
    """
    if df is None:
        return fixed_result(spark, "security", ctx, outcome("fail", f"table {ctx.asset} does not exist"))
    named = sensitive_names(df.columns, whitelist)
    if named:
        listed = F.array(
            *[F.struct(F.lit(c).alias("column"), F.lit(p).alias("pattern")) for c, p in named.items()]
        )
        return fixed_result(
            spark, "security", ctx,
            outcome(
                "fail", f"sensitive column names: {', '.join(named)}",
                details=F.to_json(F.struct(listed.alias("sensitive_columns"))),
            ),
        )
    columns = text_columns(df, whitelist)
    clean = outcome("pass", "nothing sensitive in column names or values")
    if not columns:
        return fixed_result(spark, "security", ctx, clean)
    pair = lambda e: F.struct(e["column"].alias("column"), e["kind"].alias("kind"))
    # One entry per text column and kind at most, so the list is as small as the schema.
    if measured is None:
        row = scan_sensitive(df, columns, sample).agg(F.array_sort(F.collect_list(F.struct("column", "kind"))).alias("found"))
    else:
        row = measured.select(F.array_sort(F.transform(_sensitive_hits(columns), pair)).alias("found"))
    warning = outcome(
        "warn", _text(F.size("found"), " column and kind pairs hold sensitive values"),
        details=F.to_json(F.struct(F.col("found").alias("value_pattern_hits"))),
    )
    return _result(row, "security", ctx, [(F.size("found") > 0, warning)], clean)


# --- Promotion --------------------------------------------------------------


def latest_status(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest status per key. A gate logged many times becomes one row before it travels."""
    return log.groupBy(*keys).agg(
        F.max_by("status", F.struct("executed_at", "logged_at")).alias("status")
    )


def _verdict_lists() -> list[Column]:
    """Lists of distinct gate names, over one row per gate."""

    def gates(condition: Column | None = None) -> Column:
        name = F.col("gate_name") if condition is None else F.when(condition, F.col("gate_name"))
        return F.array_sort(F.collect_list(name))

    return [
        gates().alias("observed"),
        gates(F.col("status") == "fail").alias("fails"),
        gates(F.col("status") == "warn").alias("warns"),
    ]


def _missing(required: Sequence[str]) -> Column:
    return F.filter(
        F.array(*map(F.lit, required)), lambda gate: ~F.array_contains(F.col("observed"), gate)
    )


def promotion_status(required: Sequence[str] = tuple(rules.REQUIRED_GATES)) -> Column:
    return (
        F.when(F.size(_missing(required)) > 0, "fail")
        .when(F.size("fails") > 0, "fail")
        .when(F.size("warns") > 0, "warn")
        .otherwise("pass")
    )


def promotion_by_run(log: DataFrame, required: Sequence[str] = tuple(rules.REQUIRED_GATES)) -> DataFrame:
    """The verdict of every run and asset in the log."""
    newest = latest_status(
        log.filter(F.col("gate_name") != rules.PROMOTION_GATE), ["run_id", "asset_name", "gate_name"]
    )
    verdicts = newest.groupBy("run_id", "asset_name").agg(*_verdict_lists())
    return verdicts.select(
        "run_id", "asset_name", promotion_status(required).alias("status"),
        _missing(required).alias("missing_gates"),
        F.col("fails").alias("failing_gates"), F.col("warns").alias("warning_gates"),
    )


def promotion_gate(
    log: DataFrame, ctx: GateContext, required: Sequence[str] = tuple(rules.REQUIRED_GATES)
) -> DataFrame:
    """Composite verdict over the gate rows of one run and asset.

    Rows of gates beyond the required ones count as well.
    """
    spark = log.sparkSession
    if not ctx.run_id:
        return fixed_result(spark, rules.PROMOTION_GATE, ctx, outcome("fail", "promotion needs a run id"))
    mine = log.filter(
        (F.col("run_id") == ctx.run_id)
        & (F.col("asset_name") == ctx.asset)
        & (F.col("gate_name") != rules.PROMOTION_GATE)
    )
    row = latest_status(mine, ["gate_name"]).agg(*_verdict_lists()).withColumn("missing", _missing(required))

    def listed(name: str) -> Column:
        return F.array_join(name, ", ")

    return _result(
        row, rules.PROMOTION_GATE, ctx,
        [
            (
                F.size("missing") > 0,
                outcome(
                    "fail", _text(f"run {ctx.run_id} lacks gates: ", listed("missing")),
                    details=F.to_json(
                        F.struct(F.col("missing").alias("missing_gates"), F.col("observed").alias("observed_gates"))
                    ),
                ),
            ),
            (
                F.size("fails") > 0,
                outcome(
                    "fail", _text("failed gates: ", listed("fails")),
                    details=F.to_json(
                        F.struct(F.col("fails").alias("failing_gates"), F.col("warns").alias("warning_gates"))
                    ),
                ),
            ),
            (
                F.size("warns") > 0,
                outcome(
                    "warn", _text("gates with warnings: ", listed("warns"), "; review before promoting"),
                    details=F.to_json(F.struct(F.col("warns").alias("warning_gates"))),
                ),
            ),
        ],
        outcome(
            "pass", f"all {len(required)} gates passed",
            details=F.to_json(F.struct(F.col("observed").alias("gates_passed"))),
        ),
    )


def as_log_rows(results: DataFrame) -> DataFrame:
    """Gate results in the shape of the log, metrics as JSON."""
    metrics = F.to_json(F.struct("record_count", "threshold_value", "actual_value", "details"))
    return results.select(
        "run_id", "asset_name", "gate_name", "status", "message", metrics.alias("metrics"), "executed_at"
    )


# --- Constraints ------------------------------------------------------------


def check_constraints(
    df: DataFrame,
    unique: Sequence[str] = (),
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """(rule, column, failures). NULL breaks only not_null.

    All row-wise rules share one scan. ``unique`` counts the values that occur more
    than once, with one partial aggregation per column.
    """
    accepted = accepted or {}
    tests = [("not_null", c, F.col(c).isNull()) for c in not_null]
    tests += [("accepted_values", c, ~F.col(c).isin(list(values))) for c, values in accepted.items()]
    parts = []
    if tests:
        counts = df.agg(*[count_where(test).alias(f"t{i}") for i, (_, _, test) in enumerate(tests)])
        entries = [
            F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"), F.col(f"t{i}").alias("failures"))
            for i, (rule, c, _) in enumerate(tests)
        ]
        parts.append(counts.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))
    for c in unique:
        repeated = df.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1")
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit("unique").alias("rule"), F.lit(c).alias("column"), "failures"
            )
        )
    if not parts:
        raise ValueError("no constraint given")
    return reduce(DataFrame.unionByName, parts)
