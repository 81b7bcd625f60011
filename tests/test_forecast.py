import math
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicloom import schemas
from civicloom.functions import stats
from civicloom.operators import forecast
from civicloom.operators.gates import GateContext
from civicloom.sources.sinks import read_gate_log

CTX = GateContext("gold.forecast", "run1", datetime(2025, 1, 1))
# Base, linear, quadratic, season and noise of five made-up series.
SERIES = {
    "BRONX": (120, 0.015, 0.0, 25, 15),
    "BROOKLYN": (250, 0.030, 0.00001, 40, 20),
    "MANHATTAN": (300, 0.0, 0.00002, 50, 25),
    "QUEENS": (200, 0.025, 0.0, 35, 18),
    "STATEN ISLAND": (60, 0.005, 0.0, 10, 8),
}


@pytest.fixture(scope="module")
def daily(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range((date(2025, 1, 1) - date(2017, 1, 1)).days):
        day = date.fromordinal(date(2017, 1, 1).toordinal() + i)
        season = math.sin(2 * math.pi * day.timetuple().tm_yday / 365.25)
        for name, (base, line, bend, swing, noise) in SERIES.items():
            value = base + line * i + bend * i * i + swing * season + rng.normal(0, noise)
            rows.append((day, name, max(0, round(value))))
    rows.append((date(2024, 1, 1), None, 5))
    rows += [(date(2024, m, 1), "SHORT", 5 + m) for m in range(1, 13)]
    return spark.createDataFrame(rows, "complaint_date date, borough string, total_complaints bigint")


@pytest.fixture(scope="module")
def series(daily):
    return forecast.monthly_series(daily).cache()


def ys(series, name):
    return np.array([r.monthly_count for r in series.filter(F.col("borough") == name).orderBy("t").collect()], float)


@pytest.mark.parametrize(
    "p, df, want",
    [(0.975, 1, 12.7062047), (0.975, 2, 4.3026527), (0.975, 5, 2.5705818), (0.975, 21, 2.0796138), (0.975, 60, 2.0002978),
     (0.975, 77, 1.9912544), (0.95, 10, 1.8124611), (0.995, 30, 2.7499957), (0.975, 1e6, 1.9599667)],
)
def test_t_quantile_tables(p, df, want):
    assert stats.t_quantile(np.array([p]), np.array([df]))[0] == pytest.approx(want, abs=2e-6)


@pytest.mark.parametrize(
    "x, df, want",
    [(21.0260698, 12, 0.05), (11.0704977, 5, 0.05), (19.6751376, 11, 0.05), (3.8414588, 1, 0.05), (5.9914645, 2, 0.05),
     (6.6348966, 1, 0.01), (26.2169673, 12, 0.01), (0.0, 3, 1.0), (7.8147279, 3, 0.05)],
)
def test_chi2_tables(x, df, want):
    assert stats.chi2_tail(np.array([x]), np.array([df]))[0] == pytest.approx(want, abs=1e-8)


def test_distributions_of_nothing():
    assert np.isnan(stats.chi2_tail(np.array([np.nan]), np.array([4]))[0])
    assert np.isnan(stats.t_quantile(np.array([0.975]), np.array([0]))[0])
    assert stats.chi2_tail(np.array([]), np.array([])).size == 0


def test_monthly_series(series):
    assert series.filter("borough IS NULL").count() == 0
    row = series.filter("borough = 'BRONX'").agg(F.min("month_start"), F.max("t"), F.count("*")).first()
    assert tuple(row) == (date(2017, 1, 1), 96, 96)


def test_index_skips_absent_months(spark):
    df = spark.createDataFrame([(date(2024, 1, 3), "a", 1), (date(2024, 5, 3), "a", 2)], "complaint_date date, borough string, total_complaints bigint")
    assert [(r.month_start.month, r.t) for r in forecast.monthly_series(df).orderBy("t").collect()] == [(1, 1), (5, 2)]


def test_fits_match_polyfit(series):
    fits = {r.borough: r for r in forecast.fit_trends(series).collect()}
    assert set(fits) == set(SERIES)  # the short series is left out
    for name, fit in fits.items():
        y = ys(series, name)
        n, t = len(y), np.arange(1, len(y) + 1)
        for model, degree in (("linear", 1), ("quadratic", 2)):
            resid = y - np.polyval(np.polyfit(t, y, degree), t)
            ssr, k = float(resid @ resid), degree + 1
            ll = -n / 2 * (math.log(2 * math.pi) + math.log(ssr / n) + 1)
            assert fit[f"{model}_mse"] == pytest.approx(ssr / n, rel=1e-9)
            assert fit[f"{model}_rmse"] == pytest.approx(math.sqrt(ssr / n), rel=1e-9)
            assert fit[f"{model}_aic"] == pytest.approx(-2 * ll + 2 * k, rel=1e-10)
            assert fit[f"{model}_sic"] == pytest.approx(-2 * ll + k * math.log(n), rel=1e-10)
            tss = float(((y - y.mean()) ** 2).sum())
            assert fit[f"{model}_r2_adj"] == pytest.approx(1 - (ssr / (n - k)) / (tss / (n - 1)), abs=1e-9)
            r = [float(resid[lag:] @ resid[:-lag]) / ssr for lag in range(1, 13)]
            q = n * (n + 2) * sum(v * v / (n - lag) for lag, v in enumerate(r, 1))
            assert fit[f"{model}_q"] == pytest.approx(q, rel=1e-7)


@pytest.mark.parametrize("months, kept, lags", [(23, 0, None), (24, 1, 4), (25, 1, 5), (64, 1, 12)])
def test_minimum_length_and_lags(spark, months, kept, lags):
    rows = [(date(2000 + m // 12, m % 12 + 1, 1), "a", 100 + (m * 37) % 11) for m in range(months)]
    df = spark.createDataFrame(rows, "complaint_date date, borough string, total_complaints bigint")
    fits = forecast.with_whiteness(forecast.fit_trends(forecast.monthly_series(df))).collect()
    assert [f.lags for f in fits] == ([lags] if kept else [])
    if kept:
        assert 0 <= fits[0].linear_pvalue <= 1


def test_flat_series_is_not_white(spark):
    rows = [(date(2000 + m // 12, m % 12 + 1, 1), "a", 7) for m in range(30)]
    df = spark.createDataFrame(rows, "complaint_date date, borough string, total_complaints bigint")
    row = forecast.trend_models(forecast.monthly_series(df)).first()
    assert row.linear_pvalue is None and row.linear_white is False and row.selected_model == "linear"


@pytest.mark.parametrize("linear, want", [(102.01, "quadratic"), (102.0, "linear"), (97.9, "linear"), (100.0, "linear")])
def test_model_choice_band(spark, linear, want):
    fits = spark.createDataFrame([(linear, 100.0)], "linear_sic double, quadratic_sic double")
    row = forecast.select_model(fits).first()
    assert row.selected_model == want and row.selection_reason


def test_forecast_matches_closed_form(series):
    models = forecast.trend_models(series)
    chosen = {r.borough: r.selected_model for r in models.collect()}
    assert set(chosen.values()) == {"linear", "quadratic"}
    rows = forecast.forecast(models, 12, 0.95).collect()
    assert len(rows) == 60
    for name, model in chosen.items():
        y = ys(series, name)
        n, degree = len(y), 1 if model == "linear" else 2
        x = np.vander(np.arange(1, n + 1), degree + 1).astype(float)
        beta, *_ = np.linalg.lstsq(x, y, rcond=None)
        resid = y - x @ beta
        sigma2 = resid @ resid / (n - degree - 1)
        t = stats.t_quantile(np.array([0.975]), np.array([n - degree - 1]))[0]
        mine = sorted((r for r in rows if r.borough == name), key=lambda r: r.forecast_month)
        assert mine[0].forecast_month == date(2025, 1, 1) and mine[-1].forecast_month == date(2025, 12, 1)
        for step, row in enumerate(mine, 1):
            x0 = np.vander([n + step], degree + 1).astype(float)[0]
            half = t * math.sqrt(sigma2 * (1 + x0 @ np.linalg.solve(x.T @ x, x0)))
            assert row.point_forecast == pytest.approx(x0 @ beta, rel=1e-6)
            assert row.lower_pi == pytest.approx(x0 @ beta - half, rel=1e-6)
            assert row.upper_pi == pytest.approx(x0 @ beta + half, rel=1e-6)
            assert (row.pi_level, row.model_type) == (0.95, model)


def test_one_shuffle_for_the_fit(daily):
    fits = forecast.fit_trends(forecast.monthly_series(daily.filter("total_complaints >= 0")))
    plan = fits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the monthly totals, then the groups


def test_run_publishes_and_logs(spark, daily, tmp_path):
    target, log = f"{tmp_path}/forecast", f"{tmp_path}/log"
    for _ in range(2):
        models, row = forecast.run_trend_forecast(daily, CTX, target, log)
    published = spark.read.parquet(target)
    assert published.count() == 60 and models.count() == 5
    assert set(published.columns) == set(schemas.FORECAST.fieldNames())
    logged = read_gate_log(spark, log)
    assert logged.count() == 2 and logged.first().gate_name == "trend_forecast"
    assert logged.first().status == "warn"  # the season is left in the residuals
    checks = {r.check_name: (r.passed, r.severity) for r in forecast.forecast_checks(logged).collect()}
    assert checks == {"residual_whitenoise": (False, "warn"), "sic_selection_health": (True, "warn")}


def test_run_without_a_long_series_fails(spark, daily, tmp_path):
    short = daily.filter("borough = 'SHORT'")
    models, row = forecast.run_trend_forecast(short, CTX, f"{tmp_path}/f", f"{tmp_path}/l")
    assert models.count() == 0 and row.first().status == "fail"
    checks = {r.check_name: (r.passed, r.severity) for r in forecast.forecast_checks(read_gate_log(spark, f"{tmp_path}/l")).collect()}
    assert checks == {"residual_whitenoise": (False, "error"), "sic_selection_health": (True, "warn")}


def logged(spark, status, metrics):
    row = ("r", "a", "trend_forecast", status, "m", metrics, datetime(2024, 1, 1), datetime(2024, 1, 1))
    return spark.createDataFrame([row], schemas.GATE_LOG)


def test_forecast_checks_branches(spark):
    def passed(log):
        return [r.passed for r in forecast.forecast_checks(log).collect()]

    assert passed(spark.createDataFrame([], schemas.GATE_LOG)) == [False, False]
    assert passed(logged(spark, "pass", '{"groups_processed": 3, "groups_weak_sic": 3}')) == [True, False]
    assert passed(logged(spark, "pass", '{"groups_processed": 3, "groups_weak_sic": 2}')) == [True, True]
    assert passed(logged(spark, "warn", None)) == [False, False]
    fits = '{"boroughs": [{"fit_linear": {"sic": 10.0}, "fit_quadratic": {"sic": %s}}]}'
    assert passed(logged(spark, "pass", fits % 11.9)) == [True, False]
    assert passed(logged(spark, "pass", fits % 12.0)) == [True, True]


def test_white_residuals_pass(spark):
    rng = np.random.default_rng(3)
    rows = [(date(2000 + m // 12, m % 12 + 1, 1), "a", int(1000 + 5 * m + rng.normal(0, 20))) for m in range(120)]
    df = spark.createDataFrame(rows, "complaint_date date, borough string, total_complaints bigint")
    models = forecast.trend_models(forecast.monthly_series(df))
    assert forecast.forecast_log_row(models, CTX, 12, 0.95).first().status == "pass"
