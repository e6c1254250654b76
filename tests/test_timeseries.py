import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.timeseries import series as TS
from adlake.timeseries.models import MIN_DAYS, adf, adf_p_value, arima, arima_fit, long_order, max_lag
from tests.conftest import SMOKE

FIRST = dt.date(2010, 1, 1)


def frame(spark, series):
    rows = [(k, FIRST + dt.timedelta(days=i), float(v)) for k, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id long, day date, value double")


def simulated(n, ar, ma=(), d=0, seed=0):
    rng = np.random.default_rng(seed)
    e = rng.standard_normal(n + 200)
    x = np.zeros(n + 200)
    for t in range(5, len(x)):
        x[t] = sum(a * x[t - i] for i, a in enumerate(ar, 1)) + e[t] + sum(m * e[t - j] for j, m in enumerate(ma, 1))
    x = x[200:]
    for _ in range(d):
        x = np.cumsum(x)
    return x


# Independent versions, from the values themselves.


def adf_by_regressions(y):
    n, best = len(y), (math.inf, 0)
    dy = np.diff(y)

    def fit(lag, start):
        X = np.array([[1.0, y[t], *(dy[t - i] for i in range(1, lag + 1))] for t in range(start, len(dy))])
        beta = np.linalg.lstsq(X, dy[start:], rcond=None)[0]
        left = float(((dy[start:] - X @ beta) ** 2).sum())
        return X, beta, left

    for lag in range(max_lag(n) + 1):
        X, _, left = fit(lag, max_lag(n))
        if len(X) > X.shape[1]:
            best = min(best, (len(X) * math.log(left / len(X)) + 2 * X.shape[1], lag))
    X, beta, left = fit(best[1], best[1])
    return beta[1] / math.sqrt(left / (len(X) - X.shape[1]) * np.linalg.inv(X.T @ X)[1, 1]), best[1], len(X)


def shocks_of(x, ar, ma):
    e = np.zeros(len(x))
    for t in range(len(x)):
        e[t] = x[t] - sum(a * x[t - i] for i, a in enumerate(ar, 1) if t >= i) - sum(m * e[t - j] for j, m in enumerate(ma, 1) if t >= j)
    return e


def least_squares_arma(x, p, q, rounds=60):
    """Coefficients with the least sum of squared shocks, by Gauss-Newton steps
    from a plain autoregression, with numeric derivatives."""
    design = np.column_stack([x[p - i : len(x) - i] for i in range(1, p + 1)])
    c = np.concatenate([np.linalg.lstsq(design, x[p:], rcond=None)[0], np.zeros(q)])
    loss = lambda c: float((shocks_of(x, c[:p], c[p:]) ** 2).sum())
    for _ in range(rounds):
        e = shocks_of(x, c[:p], c[p:])
        jac = np.column_stack([(shocks_of(x, *np.split(c + 1e-6 * np.eye(p + q)[i], [p])) - e) / 1e-6 for i in range(p + q)])
        step, size = np.linalg.lstsq(jac, -e, rcond=None)[0], 1.0
        while size > 1e-4 and not loss(c + size * step) < loss(c):
            size /= 2
        if size <= 1e-4 or np.abs(size * step).max() < 1e-7:
            break
        c = c + size * step
    return c


# ADF.


def test_adf_equals_regressions_on_every_series(spark):
    from adlake.plans.keys_aggwin import events_daily
    given = TS.first_difference(events_daily(spark, SMOKE)).select("series_id", "day", "value").collect()
    series = {}
    for r in sorted(given, key=lambda r: r.day):
        series.setdefault(r.series_id, []).append(r.value)
    series |= {1000 + n: simulated(n, (0.4,), seed=n) * 50 + 1e4 for n in (8, 9, 12, 40, 150, 333)}
    series |= {2000 + n: simulated(n, (0.2, 0.1), d=1, seed=n) for n in (25, 200)}
    got = {r.series_id: r for r in adf(frame(spark, series)).collect()}
    assert set(got) == set(series)
    for k, y in series.items():
        stat, lag, rows = adf_by_regressions(np.array(y))
        assert (got[k].used_lag, got[k].nobs) == (lag, rows), k
        assert abs(got[k].adf_stat - stat) < 1e-6 * max(1, abs(stat)), k
        assert abs(got[k].p_value - adf_p_value(stat)) < 1e-6


def test_adf_of_short_and_constant_series(spark):
    series = {1: [3.0] * 30, 2: [1.0] * (MIN_DAYS - 1), 3: [float(i) for i in range(40)], 4: simulated(400, (0.3,)), 5: simulated(400, (0.0,), d=1, seed=1)}
    got = {r.series_id: r for r in adf(frame(spark, series)).collect()}
    assert all(math.isnan(got[k].adf_stat) and math.isnan(got[k].p_value) for k in (1, 2, 3))
    assert got[4].p_value < 0.01 < 0.1 < got[5].p_value and got[4].adf_stat < got[4].crit_1
    assert adf(frame(spark, {1: [1.0]}).limit(0)).count() == 0


def test_adf_p_value():
    assert abs(adf_p_value(-2.8615) - 0.05) < 0.001 and abs(adf_p_value(-3.4303) - 0.01) < 0.0005
    assert adf_p_value(5.0) == 1.0 and adf_p_value(-30.0) == 0.0 and adf_p_value(0.0) > 0.9


# ARIMA.


@pytest.mark.parametrize("ar,ma,d,tolerance", [((0.7,), (), 0, 0.01), ((-0.5,), (), 1, 0.01), ((0.6,), (0.4,), 0, 0.04), ((0.5,), (0.3,), 1, 0.04),
                                               ((0.5, -0.6, 0.3), (0.6, 0.5), 1, 0.1)])
def test_coefficients_agree_with_least_squares(spark, ar, ma, d, tolerance):
    p, q = len(ar), len(ma)
    y = simulated(2500, ar, ma, d, seed=3)
    fit = arima_fit(frame(spark, {1: y}), (p, d, q)).collect()[0]
    x = np.diff(y, n=d)
    assert abs(fit.mean - x.mean()) < 1e-9
    want = least_squares_arma(x - x.mean(), p, q)
    assert np.abs(np.array(fit.coefs) - want).max() < tolerance, (fit.coefs, want)
    assert np.abs(np.array(fit.coefs) - [*ar, *ma]).max() < 0.12
    assert abs(fit.sigma2 - 1.0) < 0.1
    assert np.allclose(fit.shocks, shocks_of(x - x.mean(), fit.coefs[:p], fit.coefs[p:]))


def test_long_autoregression_and_regression_equal_least_squares(spark):
    """The estimate itself, from matrices of the values."""
    series = {k: simulated(n, (0.5, -0.3), (0.4,), 1, seed=k) * 30 + 500 for k, n in ((1, 30), (2, 31), (3, 120), (4, 700))}
    got = {r.series_id: r for r in arima_fit(frame(spark, series), (2, 1, 1)).collect()}
    for k, y in series.items():
        x = np.diff(y) - np.diff(y).mean()
        m = long_order(len(x), 2, 1)
        lags = lambda v, n, start: np.column_stack([v[start - i : len(v) - i] for i in range(1, n + 1)])
        e = np.zeros(len(x))
        e[m:] = x[m:] - lags(x, m, m) @ np.linalg.lstsq(lags(x, m, m), x[m:], rcond=None)[0]
        start = max(2, m + 1)
        for _ in range(2):
            beta = np.linalg.lstsq(np.hstack([lags(x, 2, start), lags(e, 1, start)]), x[start:], rcond=None)[0]
            e = shocks_of(x, beta[:2], beta[2:])
        assert np.allclose(got[k].coefs, beta, atol=1e-7), k
        assert np.allclose(got[k].shocks, e)


def test_forecasts_equal_closed_forms(spark):
    """AR(1): mean + phi^h x and s^2 (1 - phi^2h) / (1 - phi^2); MA(1): one step
    of theta e, then the mean, and s^2 (1 + theta^2); a random walk with drift."""
    series = {1: simulated(400, (0.7,), seed=4) + 20, 2: simulated(400, (), (0.5,), seed=5) - 3}
    daily = frame(spark, series)
    for order in ((1, 0, 0), (0, 0, 1)):
        fits = {r.series_id: r for r in arima_fit(daily, order).collect()}
        ahead = {(r.series_id, r.step): r for r in arima(daily, order, 25).where("kind = 'forecast'").collect()}
        assert len(ahead) == 50
        for (k, h), r in ahead.items():
            f = fits[k]
            if order[0]:
                phi = f.coefs[0]
                mean, variance = f.mean + phi ** h * f.xs[-1], f.sigma2 * (1 - phi ** (2 * h)) / (1 - phi ** 2)
            else:
                theta = f.coefs[0]
                mean, variance = f.mean + (theta * f.shocks[-1] if h == 1 else 0.0), f.sigma2 * (1 + (theta ** 2 if h > 1 else 0.0))
            assert abs(r.mean - mean) < 1e-9 and abs(r.std_error - math.sqrt(variance)) < 1e-9
            assert abs(r.upper - r.mean - 1.959963984540054 * r.std_error) < 1e-9
    f = {r.series_id: r for r in arima_fit(daily, (0, 1, 0)).collect()}
    for r in arima(daily, (0, 1, 0), 25).where("kind = 'forecast'").collect():
        assert abs(r.mean - (f[r.series_id].ys[-1] + r.step * f[r.series_id].mean)) < 1e-8
        assert abs(r.std_error - math.sqrt(f[r.series_id].sigma2 * r.step)) < 1e-9


def test_forecast_of_a_mixed_model_by_simulation(spark):
    """(3,1,2): recursions in plain numpy from the fitted parameters."""
    y = simulated(300, (0.5, -0.6, 0.3), (0.6, 0.5), 1, seed=9)
    daily = frame(spark, {1: y})
    f = arima_fit(daily, (3, 1, 2)).collect()[0]
    x, e = list(f.xs), list(f.shocks)
    for _ in range(25):
        x.append(sum(f.coefs[i] * x[-1 - i] for i in range(3)) + sum(f.coefs[3 + j] * e[-1 - j] for j in range(2)))
        e.append(0.0)
    mean = y[-1] + np.cumsum(np.array(x[-25:]) + f.mean)
    pulse = shocks_of(np.zeros(26), f.coefs[:3], f.coefs[3:])
    pulse = np.zeros(26)
    for t in range(26):  # answer to a shock of 1, summed up
        pulse[t] = (t == 0) + (f.coefs[2 + t] if 1 <= t <= 2 else 0) + sum(f.coefs[i] * pulse[t - 1 - i] for i in range(3) if t - 1 - i >= 0)
    error = np.sqrt(f.sigma2 * np.cumsum(np.cumsum(pulse[:25]) ** 2))
    rows = arima(daily, (3, 1, 2), 25).orderBy("kind", "step").collect()
    ahead = [r for r in rows if r.kind == "forecast"]
    assert np.allclose([r.mean for r in ahead], mean) and np.allclose([r.std_error for r in ahead], error)
    fitted = [r for r in rows if r.kind == "fitted"]
    assert [r.step for r in fitted] == list(range(300)) and fitted[0].mean is None
    assert np.allclose([r.mean for r in fitted[1:]], y[1:] - np.array(f.shocks))
    assert ahead[0].day == fitted[-1].day + dt.timedelta(days=1)


def test_forecast_intervals_cover(spark):
    series = {seed: simulated(425, (0.6,), (0.3,), 1, seed=seed) for seed in range(60)}
    rows = arima(frame(spark, {k: y[:400] for k, y in series.items()}), (1, 1, 1)).where("kind = 'forecast'").collect()
    inside = [r.lower <= series[r.series_id][399 + r.step] <= r.upper for r in rows]
    assert len(inside) == 1500 and 0.88 < np.mean(inside) < 1.0


def test_short_and_constant_series_drift(spark):
    series = {1: simulated(120, (0.5,), d=1, seed=1), 2: [5.0], 3: [2.0 * i for i in range(6)], 4: [7.0] * 60, 5: [1.0, 2.0]}
    out = arima(frame(spark, series)).where("kind = 'forecast'").collect()
    assert {r.series_id for r in out} == {1, 3, 4} and len(out) == 75
    assert [r.mean for r in sorted(out, key=lambda r: r.step) if r.series_id == 3][:2] == [12.0, 14.0]
    assert all(r.mean == 7.0 and r.std_error == 0.0 for r in out if r.series_id == 4)
    assert arima(frame(spark, {1: [1.0]}).limit(0)).count() == 0


def test_series_are_fitted_in_many_tasks(spark):
    from adlake.plans.keys_aggwin import arima_forecast
    rows = arima_forecast(spark, SMOKE)
    assert rows.rdd.getNumPartitions() == 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def test_rows_of_days_stay_in_the_jvm(spark):
    plan = arima(frame(spark, {1: [1.0, 2.0]}))._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "MapInPandas" not in plan


# PACF and exact statistics.


def test_pacf_of_ar1_cuts_off(spark):
    y = np.round(simulated(3000, (0.6,), seed=5) * 1000)
    s = frame(spark, {1: y, 2: [3.0] * 30, 3: [1.0, 2.0, 4.0]}).select("series_id", "day", F.col("value").cast("long").alias("cents"))
    got = {(r.series_id, r.lag): r.pacf for r in TS.pacf(s, 5).collect()}
    assert abs(got[1, 1] - 0.6) < 0.05 and all(abs(got[1, k]) < 0.06 for k in range(2, 6))
    assert set(got) == {(k, i) for k in (1, 2) for i in range(1, 6)} | {(3, 1)} and got[2, 1] is None


def test_long_series_with_large_values_is_exact(spark):
    values = [100_000 + (2_000 if i % 2 else -2_000) * (1 + i % 5) for i in range(1000)]
    s = spark.createDataFrame([(1, dt.date(2020, 1, 1) + dt.timedelta(days=i), v * 100) for i, v in enumerate(values)], "series_id long, day date, cents long")
    x = np.array(values, float)
    x -= x.mean()
    for r in TS.acf(s).collect():
        assert abs(r.acf - (x[: -r.lag] @ x[r.lag :]) / (x @ x)) < 1e-12
    rows = TS.rolling_stats(s.withColumn("cents", s["cents"] * 100_000)).orderBy("day").collect()
    assert rows[10].rolling_std is None
    assert abs(rows[500].rolling_std / (np.std(values[489:501], ddof=1) * 1e5) - 1) < 1e-9
