"""Monthly trend models per group: fit, choose, test, forecast.

A group has at most one row per month, so whatever is ordered within a group is
calendar-bounded. The index runs 1..N; centring it on its mean makes the linear and
quadratic terms uncorrelated, and the least-squares solutions become closed formulas
of a few sums. The residual pass reuses the same partitioning, so a whole fit costs
one shuffle of the monthly rows.
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from civicloom import rules
from civicloom.functions.columns import count_where, timestamp_literal
from civicloom.functions.stats import chi2_tail_udf, t_quantile_udf
from civicloom.functions.windows import with_time_index
from civicloom.operators.gates import GateContext
from civicloom.session import stage_table
from civicloom.sources.sinks import append_gate_log, replace_run

MODELS = {"linear": 2, "quadratic": 3}  # name -> number of parameters


def monthly_series(
    df: DataFrame, date_col: str = "complaint_date", group_col: str = "borough", count_col: str = "total_complaints"
) -> DataFrame:
    """(borough, month_start, monthly_count, t). The index counts rows, so it skips absent months."""
    monthly = (
        df.filter(F.col(group_col).isNotNull())
        .groupBy(F.col(group_col).alias("borough"), F.trunc(date_col, "MM").alias("month_start"))
        .agg(F.sum(count_col).cast("bigint").alias("monthly_count"))
    )
    return with_time_index(monthly, "borough", "month_start")


def _centre(n: Column) -> Column:
    return (n + 1) / 2.0


def _square_sum(n: Column) -> Column:
    """Sum of squares of the centred index 1..n."""
    return n * (n * n - 1) / 12.0


def _fourth_sum(n: Column) -> Column:
    """Sum of fourth powers of the centred index 1..n."""
    return n * (n * n - 1) * (3 * n * n - 7) / 240.0


def fit_trends(series: DataFrame, min_months: int = rules.MIN_MONTHS) -> DataFrame:
    """One row per group: coefficients and fit statistics of both models.

    Coefficients belong to the index centred on (n+1)/2. Groups with fewer than
    ``min_months`` months are left out.
    """
    group = Window.partitionBy("borough")
    n = F.col("n").cast("double")
    u, y = F.col("u"), F.col("y")
    sized = (
        series.select("borough", "month_start", "t", F.col("monthly_count").cast("double").alias("y"))
        .withColumn("n", F.count(F.lit(1)).over(group))
        .filter(F.col("n") >= min_months)
        .withColumn("u", F.col("t").cast("double") - _centre(n))
        .withColumn("mean", F.avg("y").over(group))
    )
    bend = u * u - _square_sum(n) / n  # the quadratic term, made orthogonal to the other two
    fitted = (
        sized.withColumn("slope", F.sum(u * (y - F.col("mean"))).over(group) / _square_sum(n))
        .withColumn(
            "curve",
            F.sum(bend * (y - F.col("mean"))).over(group)
            / (_fourth_sum(n) - _square_sum(n) * _square_sum(n) / n),
        )
        .withColumn("e_linear", y - F.col("mean") - F.col("slope") * u)
        .withColumn("e_quadratic", F.col("e_linear") - F.col("curve") * bend)
    )
    ordered = group.orderBy("t")
    lagged = fitted.select(
        "*",
        *[
            F.lag(f"e_{model}", k).over(ordered).alias(f"{model}_lag{k}")
            for model in MODELS
            for k in range(1, rules.LJUNG_BOX_LAGS + 1)
        ],
    )
    sums = lagged.groupBy("borough").agg(
        F.max("n").alias("n_obs"),
        F.max("month_start").alias("last_month"),
        F.max("mean").alias("mean"),
        F.max("slope").alias("slope"),
        F.max("curve").alias("curve"),
        F.sum((y - F.col("mean")) * (y - F.col("mean"))).alias("tss"),
        *[F.sum(F.col(f"e_{m}") * F.col(f"e_{m}")).alias(f"ssr_{m}") for m in MODELS],
        *[
            F.sum(F.col(f"e_{m}") * F.col(f"{m}_lag{k}")).alias(f"{m}_c{k}")
            for m in MODELS
            for k in range(1, rules.LJUNG_BOX_LAGS + 1)
        ],
    )
    size = F.col("n_obs").cast("double")
    lags = F.least(F.lit(rules.LJUNG_BOX_LAGS), F.greatest(F.lit(1), F.floor(size / 5))).cast("int")
    return sums.select(
        "borough", "n_obs", "last_month", "mean", "slope", "curve", lags.alias("lags"),
        *[column for model, k in MODELS.items() for column in _fit_columns(model, k, size, lags)],
    )


def _fit_columns(model: str, k: int, n: Column, lags: Column) -> list[Column]:
    ssr = F.col(f"ssr_{model}")
    deviance = n * math.log(2 * math.pi) + n * F.ln(ssr / n) + n
    spread = 1 - (ssr / (n - k)) / (F.nullif(F.col("tss"), F.lit(0.0)) / (n - 1))
    return [
        ssr.alias(f"{model}_ssr"),
        (deviance + 2 * k).alias(f"{model}_aic"),
        (deviance + k * F.ln(n)).alias(f"{model}_sic"),
        (ssr / n).alias(f"{model}_mse"),
        F.sqrt(ssr / n).alias(f"{model}_rmse"),
        spread.alias(f"{model}_r2_adj"),
        ljung_box(model, n, lags).alias(f"{model}_q"),
    ]


def ljung_box(model: str, n: Column, lags: Column) -> Column:
    """Q statistic over the first ``lags`` residual autocorrelations; NULL without spread."""
    ssr = F.nullif(F.col(f"ssr_{model}"), F.lit(0.0))
    total = F.lit(0.0)
    for k in range(1, rules.LJUNG_BOX_LAGS + 1):
        r = F.col(f"{model}_c{k}") / ssr
        total = total + F.when(lags >= k, r * r / (n - k)).otherwise(0.0)
    return n * (n + 2) * total


def with_whiteness(fits: DataFrame) -> DataFrame:
    """Add the p-value of the residual test and whether it passes (NULL does not)."""
    for model in MODELS:
        p = chi2_tail_udf(F.col(f"{model}_q"), F.col("lags").cast("double"))
        fits = fits.withColumn(f"{model}_pvalue", F.nanvl(p, F.lit(None).cast("double")))
    return fits.select(
        "*",
        *[
            F.coalesce(F.col(f"{m}_pvalue") > rules.LJUNG_BOX_ALPHA, F.lit(False)).alias(f"{m}_white")
            for m in MODELS
        ],
    )


def select_model(fits: DataFrame) -> DataFrame:
    """Quadratic only when its SIC is better by more than the band; otherwise linear."""
    delta = F.col("linear_sic") - F.col("quadratic_sic")
    shown = F.format_string("%.2f", F.abs(delta))
    return fits.select(
        "*",
        delta.alias("sic_delta"),
        F.when(delta > rules.SIC_BAND, "quadratic").otherwise("linear").alias("selected_model"),
        F.when(delta > rules.SIC_BAND, F.concat(F.lit("quadratic is better by SIC "), shown))
        .when(delta < -rules.SIC_BAND, F.concat(F.lit("linear is better by SIC "), shown))
        .otherwise(F.concat(F.lit("SIC differs by only "), shown, F.lit(", the simpler model is kept")))
        .alias("selection_reason"),
    )


def chosen(name: str) -> Column:
    """A statistic of the selected model."""
    return F.when(F.col("selected_model") == "quadratic", F.col(f"quadratic_{name}")).otherwise(
        F.col(f"linear_{name}")
    )


def forecast(
    selected: DataFrame, horizon: int = rules.HORIZON_MONTHS, level: float = rules.INTERVAL_LEVEL
) -> DataFrame:
    """``horizon`` months per group with the interval for a new observation."""
    n = F.col("n_obs").cast("double")
    bent = F.col("selected_model") == "quadratic"
    parameters = F.when(bent, MODELS["quadratic"]).otherwise(MODELS["linear"])
    per_group = selected.withColumn("freedom", n - parameters).withColumn(
        "t_value", t_quantile_udf(F.lit((1 + level) / 2), F.col("freedom"))
    )
    steps = per_group.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).withColumn("u", n + F.col("step") - _centre(n))
    u = F.col("u")
    bend = u * u - _square_sum(n) / n
    leverage = 1 / n + u * u / _square_sum(n) + F.when(
        bent, bend * bend / (_fourth_sum(n) - _square_sum(n) * _square_sum(n) / n)
    ).otherwise(0.0)
    half = F.col("t_value") * F.sqrt(chosen("ssr") / F.col("freedom") * (1 + leverage))
    point = F.col("mean") + F.col("slope") * u + F.when(bent, F.col("curve") * bend).otherwise(0.0)
    return steps.select(
        "borough",
        F.add_months("last_month", F.col("step")).alias("forecast_month"),
        point.alias("point_forecast"),
        (point - half).alias("lower_pi"),
        (point + half).alias("upper_pi"),
        F.lit(float(level)).alias("pi_level"),
        F.col("selected_model").alias("model_type"),
        chosen("aic").alias("aic"), chosen("sic").alias("sic"), chosen("rmse").alias("rmse"),
    )


def trend_models(series: DataFrame, min_months: int = rules.MIN_MONTHS) -> DataFrame:
    """Fits, residual tests and the chosen model, one row per group."""
    return select_model(with_whiteness(fit_trends(series, min_months)))


def forecast_log_row(
    models: DataFrame, ctx: GateContext, horizon: int, level: float
) -> DataFrame:
    """The log row of a forecast run.

    Its metrics hold totals over all groups, however many there are; the fits of
    every group are a table of their own (``trend_models``).
    """
    delta = F.abs("sic_delta")
    row = models.agg(
        F.count(F.lit(1)).alias("groups_processed"),
        count_where(~chosen("white")).alias("groups_not_white"),
        count_where(delta < rules.SIC_BAND).alias("groups_weak_sic"),
        F.max(delta).alias("max_abs_sic_delta"),
        F.min(delta).alias("min_abs_sic_delta"),
    )
    status = (
        F.when(F.col("groups_processed") == 0, "fail")
        .when(F.col("groups_not_white") > 0, "warn")
        .otherwise("pass")
    )
    message = (
        F.when(status == "fail", "no group has enough months")
        .when(
            status == "warn",
            F.concat(
                F.col("groups_not_white").cast("string"),
                F.lit(" groups keep structure in their residuals; a trend alone does not explain them"),
            ),
        )
        .otherwise(F.concat(F.lit("forecast done for "), F.col("groups_processed").cast("string"), F.lit(" groups")))
    )
    metrics = F.struct(F.lit(horizon).alias("horizon_months"), F.lit(float(level)).alias("pi_level"), *row.columns)
    return row.select(
        F.lit(ctx.run_id).alias("run_id"), F.lit(ctx.asset).alias("asset_name"),
        F.lit(rules.FORECAST_GATE).alias("gate_name"), status.alias("status"), message.alias("message"),
        F.to_json(metrics).alias("metrics"), timestamp_literal(ctx.now).alias("executed_at"),
    )


def run_trend_forecast(
    df: DataFrame,
    ctx: GateContext,
    target_path: str,
    log_path: str,
    horizon: int = rules.HORIZON_MONTHS,
    level: float = rules.INTERVAL_LEVEL,
    min_months: int = rules.MIN_MONTHS,
    **columns: str,
) -> tuple[DataFrame, DataFrame]:
    """Fit, forecast, publish this run's rows, log the run. Returns (models, log row)."""
    if ctx.run_id is None:
        raise ValueError("a forecast run needs a run id")
    models = stage_table(trend_models(monthly_series(df, **columns), min_months), "trend_models")
    rows = forecast(models, horizon, level).withColumn(
        "generated_at", timestamp_literal(ctx.now)
    )
    replace_run(rows, target_path, ctx.run_id)
    log_row = forecast_log_row(models, ctx, horizon, level)
    append_gate_log(log_row, log_path)
    return models, log_row


_CHECKED_METRICS = (
    "groups_processed bigint, groups_weak_sic bigint, "
    "boroughs array<struct<fit_linear:struct<sic:double>,fit_quadratic:struct<sic:double>>>"
)


def forecast_checks(log: DataFrame) -> DataFrame:
    """Two checks on the newest forecast run in the log: residuals, and clear model choice.

    Older logs that list the fits of every group in their metrics are understood too.
    """
    newest = log.filter(F.col("gate_name") == rules.FORECAST_GATE).agg(
        F.count(F.lit(1)).alias("runs"),
        F.max_by(F.struct("status", "message", "metrics"), F.struct("executed_at", "run_id")).alias("r"),
    )
    row = newest.select(
        "runs", "r.status", "r.message", F.col("r.metrics").isNotNull().alias("has_metrics"),
        F.from_json("r.metrics", _CHECKED_METRICS).alias("m"),
    )
    listed = F.transform(
        "m.boroughs", lambda b: F.abs(b["fit_linear"]["sic"] - b["fit_quadratic"]["sic"])
    )
    processed = F.coalesce("m.groups_processed", F.size(listed))
    weak = F.coalesce("m.groups_weak_sic", F.size(F.filter(listed, lambda d: d < rules.SIC_BAND)))
    all_weak = F.coalesce((processed > 0) & (weak == processed), F.lit(False))
    some = F.col("runs") > 0
    residuals = F.struct(
        F.lit("residual_whitenoise").alias("check_name"),
        (some & (F.coalesce("status", F.lit("")) == "pass")).alias("passed"),
        F.when(F.col("status") == "fail", "error").otherwise("warn").alias("severity"),
        F.when(some, F.col("message")).otherwise("no forecast run in the log").alias("description"),
    )
    choice = F.struct(
        F.lit("sic_selection_health").alias("check_name"),
        (some & F.col("has_metrics") & ~all_weak).alias("passed"),
        F.lit("warn").alias("severity"),
        F.when(~some | ~F.col("has_metrics"), "no forecast metrics in the log")
        .when(all_weak, "no group has a clear model; the trend shape is uncertain")
        .otherwise("at least one group has a clear model")
        .alias("description"),
    )
    return row.select(F.explode(F.array(residuals, choice)).alias("c")).select("c.*")
