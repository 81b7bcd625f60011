"""Outlier findings and profiles of tables and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from civicloom import rules
from civicloom.functions.columns import count_where, timestamp_literal
from civicloom.functions.quantiles import (
    Bounds,
    column_bounds,
    exact_quantiles,
    grouped_summary,
    numeric_value,
    values_at_ranks,
)
from civicloom.functions.windows import global_rank

_KEY = "row_key"


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns that hold numbers; booleans and dates are not numbers."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _row_key(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]).alias(_KEY)


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


_Z_SCHEMA = (
    "table_name string, row_key string, anomaly_type string, column_name string, value double, "
    "mean double, std double, zscore double, severity string"
)
_IQR_SCHEMA = (
    "table_name string, row_key string, anomaly_type string, column_name string, value double, "
    "lower_bound double, upper_bound double, severity string"
)


def _present(entries: Sequence[Column]) -> Column:
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def _z_entry(column: str, mean: float, std: float, threshold: float) -> Column:
    """The column's value with its score, or NULL where it is no outlier."""
    value = numeric_value(F.col(f"`{column}`"))
    score = (value - F.lit(mean)) / F.lit(std)
    entry = F.struct(
        F.lit(column).alias("column_name"), value.alias("value"), F.lit(mean).alias("mean"), F.lit(std).alias("std"),
        score.alias("zscore"),
    )
    return F.when(F.abs(score) >= threshold, entry)


def _z_severity(score: str) -> Column:
    return F.when(F.abs(score) < rules.ZSCORE_HIGH, "medium").otherwise("high")


def _fences(bounds: Mapping[str, Bounds], quartiles: Mapping[tuple[str, float], float]) -> dict[str, tuple[float, float]]:
    """Lower and upper fence of the columns whose quartiles differ."""
    fences = {}
    for c in bounds:
        q1, q3 = quartiles[c, 0.25], quartiles[c, 0.75]
        if q3 > q1:
            reach = rules.IQR_FENCE * (q3 - q1)
            fences[c] = (q1 - reach, q3 + reach)
    return fences


def _iqr_entry(column: str, lower: float, upper: float) -> Column:
    """The column's value with its fences, or NULL where it lies inside."""
    value = numeric_value(F.col(f"`{column}`"))
    entry = F.struct(
        F.lit(column).alias("column_name"), value.alias("value"), F.lit(lower).alias("lower_bound"), F.lit(upper).alias("upper_bound")
    )
    return F.when((value < lower) | (value > upper), entry)


def zscore_anomalies(
    df: DataFrame, table: str, keys: Sequence[str], threshold: float = rules.ZSCORE_LIMIT
) -> DataFrame:
    """Values at least ``threshold`` sample deviations from their column's mean.

    Columns with fewer than ten values or no spread are left out. The statistics of
    all columns come from one scan that runs now; each row then yields only its outliers,
    so the table is never multiplied by its columns. The findings are lazy.
    """
    columns = [c for c in numeric_columns(df) if c not in keys]
    if not columns:
        return _empty(df, _Z_SCHEMA)
    values = {c: numeric_value(F.col(f"`{c}`")) for c in columns}
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(v).alias("n"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
        )
        for c, v in values.items()
    ]
    stats = [
        e for e in df.agg(F.array(*entries)).first()[0]
        if e["n"] >= rules.MIN_VALUES and e["std"] is not None and e["std"] > 0
    ]
    if not stats:
        return _empty(df, _Z_SCHEMA)
    outside = _present([_z_entry(e["column_name"], e["mean"], e["std"], threshold) for e in stats])
    return df.select(_row_key(keys), F.explode(outside).alias("e")).select(
        F.lit(table).alias("table_name"), _KEY, F.lit("zscore_outlier").alias("anomaly_type"),
        "e.column_name", "e.value", "e.mean", "e.std", "e.zscore",
        _z_severity("e.zscore").alias("severity"),
    )


def iqr_anomalies(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Values strictly outside the quartiles by one and a half times their distance.

    Columns with fewer than ten values or equal quartiles are left out. The quartiles
    are exact. Finding them runs a few counting passes now, so pass a stored table;
    the findings are lazy.
    """
    columns = [c for c in numeric_columns(df) if c not in keys]
    if not columns:
        return _empty(df, _IQR_SCHEMA)
    bounds = {c: b for c, b in column_bounds(df, columns).items() if b.count >= rules.MIN_VALUES}
    fences = _fences(bounds, exact_quantiles(df, bounds, (0.25, 0.75)))
    if not fences:
        return _empty(df, _IQR_SCHEMA)
    outside = _present([_iqr_entry(c, *fence) for c, fence in fences.items()])
    return (
        df.select(_row_key(keys), F.explode(outside).alias("e"))
        .select(
            F.lit(table).alias("table_name"), _KEY, F.lit("iqr_outlier").alias("anomaly_type"),
            "e.column_name", "e.value", "e.lower_bound", "e.upper_bound",
            F.lit("medium").alias("severity"),
        )
    )


def union_findings(*frames: DataFrame) -> DataFrame:
    """Concatenate findings whose columns differ; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def profile_table(df: DataFrame, table: str) -> DataFrame:
    """One row per column: table size, whether it is numeric, how many NULLs. One scan."""
    numeric = set(numeric_columns(df))
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[count_where(F.col(f"`{f.name}`").isNull()).alias(f"n{i}") for i, f in enumerate(df.schema.fields)],
    )
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(name in numeric).alias("is_numeric"),
            F.col(f"n{i}").alias("null_count"),
        )
        for i, name in enumerate(df.columns)
    ]
    return counts.select("row_count", F.explode(F.array(*entries)).alias("e")).select(
        F.lit(table).alias("table_name"), "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        "e.column_name", "e.is_numeric", "e.null_count",
    )


_FINDING_SCHEMA = _Z_SCHEMA.replace("severity string", "lower_bound double, upper_bound double, severity string")
_PROFILE_SCHEMA = (
    "table_name string, row_count bigint, column_count bigint, column_name string, is_numeric boolean, null_count bigint, "
    "value_count bigint, mean double, std double, low double, high double, q1 double, q3 double"
)


def table_baseline(df: DataFrame, table: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(findings, profile) of one table: z-score and fence outliers, and a row per column with its statistics.

    One scan takes counts, moments and bounds of all columns, a few counting passes narrow all quartiles
    down together, and one scan yields both kinds of outliers. All but the findings run now.
    """
    numeric = numeric_columns(df)
    checked = [c for c in numeric if c not in keys]
    values = {c: numeric_value(F.col(f"`{c}`")) for c in checked}
    measures = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "low": F.min, "high": F.max}
    row = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[count_where(F.col(f"`{c}`").isNull()).alias(f"nulls{i}") for i, c in enumerate(df.columns)],
        *[f(v).alias(f"{name}{i}") for i, v in enumerate(values.values()) for name, f in measures.items()],
    ).first()
    stats = {c: {name: row[f"{name}{i}"] for name in measures} for i, c in enumerate(checked)}
    enough = {c: Bounds(s["n"], s["low"], s["high"]) for c, s in stats.items() if s["n"] >= rules.MIN_VALUES}
    quartiles = exact_quantiles(df, enough, (0.25, 0.75))
    fences = _fences(enough, quartiles)
    spread = {c: stats[c] for c in enough if stats[c]["std"] is not None and stats[c]["std"] > 0}
    kinds = {
        "zscore_outlier": [_z_entry(c, s["mean"], s["std"], rules.ZSCORE_LIMIT) for c, s in spread.items()],
        "iqr_outlier": [_iqr_entry(c, *fence) for c, fence in fences.items()],
    }

    def full(kind: str, e: Column) -> Column:
        nothing, z = F.lit(None).cast("double"), kind == "zscore_outlier"
        return F.struct(
            F.lit(kind).alias("anomaly_type"), e["column_name"].alias("column_name"), e["value"].alias("value"),
            *[(e[name] if z else nothing).alias(name) for name in ("mean", "std", "zscore")],
            *[(nothing if z else e[name]).alias(name) for name in ("lower_bound", "upper_bound")],
        )

    lists = [F.transform(_present(entries), partial(full, kind)) for kind, entries in kinds.items() if entries]
    if lists:
        found = df.select(_row_key(keys), F.explode(F.concat(*lists)).alias("e")).select(
            F.lit(table).alias("table_name"), _KEY, "e.*",
            F.when(F.col("e.zscore").isNotNull(), _z_severity("e.zscore")).otherwise("medium").alias("severity"),
        )
    else:
        found = _empty(df, _FINDING_SCHEMA)
    profile = []
    for i, c in enumerate(df.columns):
        s = stats.get(c, {})
        profile.append((
            table, row["row_count"], len(df.columns), c, c in numeric, row[f"nulls{i}"],
            *[s.get(name) for name in measures], quartiles.get((c, 0.25)), quartiles.get((c, 0.75)),
        ))
    # One row per column of the table.
    return found, df.sparkSession.createDataFrame(profile, _PROFILE_SCHEMA)


def anomaly_baseline(
    tables: Mapping[str, tuple[DataFrame | None, Sequence[str]]],
) -> tuple[DataFrame, DataFrame, list[str]]:
    """(findings, profiles, names of absent tables) over tables given with their key columns.

    Each table is read once for its statistics and once for its findings, with a few counting
    passes between; pass stored tables.
    """
    absent = [name for name, (df, _) in tables.items() if df is None]
    made = [table_baseline(df, name, keys) for name, (df, keys) in tables.items() if df is not None]
    if not made:
        raise ValueError("none of the tables exists")
    findings, profiles = (reduce(DataFrame.unionByName, side) for side in zip(*made))
    return findings, profiles, absent


# --- Scores -----------------------------------------------------------------


def detect_columns(df: DataFrame) -> dict[str, str | None]:
    """Which columns hold the score, address, zip and borough.

    Without a known score name, the first numeric column whose values all lie in
    0..100 is taken; one scan checks all of them.
    """

    def named(names: Sequence[str]) -> str | None:
        return next((n for n in names if n in df.columns), None)

    score = named(rules.SCORE_COLUMNS)
    numeric = numeric_columns(df)
    if score is None and numeric:
        bounds = column_bounds(df, numeric)
        in_range = [c for c in numeric if bounds[c].count and bounds[c].low >= 0 and bounds[c].high <= 100]
        score = in_range[0] if in_range else None
    return {
        "score": score,
        "address": named(rules.ADDRESS_COLUMNS),
        "zip": named(rules.ZIP_COLUMNS),
        "borough": named(rules.BOROUGH_COLUMNS),
    }


def profile_score(df: DataFrame, score: str, address: str | None = None) -> DataFrame:
    """One row: counts, range, mean, exact median, p95 and p99, repeated addresses.

    All rows without an address count as one address. The quantiles take a few counting
    passes now, so pass a stored table.
    """
    value = numeric_value(F.col(score))
    at = exact_quantiles(df, column_bounds(df, [score]), (0.5, 0.95, 0.99))
    if address is None:
        repeated = F.lit(None).cast("bigint")
    else:
        nulls = F.max(F.when(F.col(address).isNull(), 1).otherwise(0))
        repeated = F.count(F.lit(1)) - F.countDistinct(address) - nulls
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.count(F.lit(1)) - F.count(value)).alias("null_score_count"),
        F.min(value).alias("min_score"),
        F.max(value).alias("max_score"),
        F.avg(value).alias("mean_score"),
        *[
            F.lit(at.get((score, p))).cast("double").alias(name)
            for name, p in (("median_score", 0.5), ("p95_score", 0.95), ("p99_score", 0.99))
        ],
        repeated.cast("bigint").alias("duplicate_address_count"),
    )


def score_warnings(profile: DataFrame) -> DataFrame:
    """The profile with what is wrong with the scores, as a list of codes."""
    codes = F.array(
        F.when(F.col("null_score_count") > 0, "null_scores"),
        F.when(F.col("min_score") < 0, "score_below_0"),
        F.when(F.col("max_score") > 100, "score_above_100"),
    )
    return profile.withColumn("warnings", F.filter(codes, lambda c: c.isNotNull()))


def score_by(df: DataFrame, key: str, score: str) -> DataFrame:
    """Count, mean, exact median, minimum and maximum per key; rows without a key are left out."""
    return grouped_summary(df.filter(F.col(key).isNotNull()), key, score)


def top_share(
    df: DataFrame, score: str, ties: Sequence[Column], share: float = 0.01, floor: int = 10
) -> DataFrame:
    """The highest ``share`` of the rows, at least ``floor``, with their rank.

    The score at the cut is found by counting, which leaves little more than the
    result to sort; the rank at the cut is then exact under ``ties``. Rows without a
    score come last. Reads ``df`` several times, so pass a stored table.
    """
    value = numeric_value(F.col(score))
    total, scored = df.agg(F.count(F.lit(1)), F.count(value)).first()
    keep = max(floor, int(total * share)) if total else 0
    candidates = df
    if 0 < keep <= scored:
        place = scored - keep
        cut = values_at_ranks(df, column_bounds(df, [score]), {score: {place}})[score, place]
        candidates = df.filter(value >= cut)
    order = [F.col(score).desc_nulls_last(), *ties]
    return global_rank(candidates, order, "score_rank").filter(F.col("score_rank") <= keep)


def tail(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The last ``n`` rows in the given order."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(n)


# --- Report -----------------------------------------------------------------

REPORT_COUNTS = ["valid_count", "pending_count", "invalid_count", "quarantine_count", "anomaly_count"]


def validation_report(
    spark: SparkSession,
    classified: DataFrame | None,
    findings: DataFrame | None,
    profile: DataFrame | None,
    absent_tables: Sequence[str] = (),
) -> DataFrame:
    """One row: counts, blocking failures, warnings and the recommendation.

    ``profile`` is a scored profile with its warnings, or None when there was no
    score to profile. The recommendation is always REVIEW: the report advises, it
    never approves.
    """
    parts = []
    if classified is not None:
        status = F.col("validation_status")
        parts.append(
            classified.agg(
                *[count_where(status == s).alias(f"{s}_count") for s in ("valid", "pending", "invalid")],
                count_where(F.col("quarantine_flag")).alias("quarantine_count"),
            )
        )
    if findings is not None:
        parts.append(findings.agg(F.count(F.lit(1)).alias("anomaly_count")))
    if profile is not None:
        parts.append(profile.select(F.array_join("warnings", ",").alias("score_warnings")))
    parts.append(
        spark.range(1).select(
            *[F.lit(0).cast("bigint").alias(c) for c in REPORT_COUNTS],
            F.lit("" if profile is not None else "no_score").alias("score_status"),
            F.lit(",".join(sorted(absent_tables))).alias("missing_tables"),
        )
    )
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    texts = ["score_warnings", "score_status", "missing_tables"]
    row = merged.agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in REPORT_COUNTS],
        *[F.max(c).alias(c) if c in merged.columns else F.lit("").alias(c) for c in texts],
    )

    def present(*items: Column) -> Column:
        return F.filter(F.array(*items), lambda x: x.isNotNull())

    return row.select(
        *REPORT_COUNTS,
        present(
            F.when(F.col("invalid_count") > 0, F.concat(F.lit("invalid_records:"), F.col("invalid_count").cast("string"))),
            F.when(F.col("score_status") != "", F.concat(F.lit("score:"), F.col("score_status"))),
        ).alias("blocking_failures"),
        present(
            F.when(F.col("missing_tables") != "", F.concat(F.lit("missing_tables:"), F.col("missing_tables"))),
            F.when(F.col("score_warnings") != "", F.concat(F.lit("score:"), F.col("score_warnings"))),
        ).alias("warnings"),
        F.lit("REVIEW").alias("promotion_recommendation"),
    )


def report_rows(report: DataFrame, asset: str, run_id: str, created_at: datetime) -> DataFrame:
    """The report as a row of the table that the validation gate reads."""
    return report.select(
        F.lit(asset).alias("asset_name"), F.lit(run_id).alias("run_id"),
        F.col("promotion_recommendation").alias("recommendation"),
        F.to_json(F.struct(*report.columns)).alias("report"),
        timestamp_literal(created_at).alias("created_at"),
    )
