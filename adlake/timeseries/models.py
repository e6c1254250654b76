"""Per-series models from sums (TS3, TS5, TS6).

A regression on lagged values needs only sums of products: each is one grouped
aggregate over windows of the *daily* series, and what a lag cuts off at either
end of a series is corrected from its first and last few values.  Python sees
one row of sums for each series and solves it; rows of days never go there.

* ADF: products of the level and its differences; the lag is chosen by AIC on
  sub-matrices of one moment matrix over the sample that all lags share.
* ARIMA by Hannan-Rissanen: a long autoregression from lagged products
  estimates the shocks, then the series is regressed on its own lags and on
  lagged shocks, and once more with the shocks of that fit.
* Shocks, fitted values and forecasts are recursions in time: column
  expressions over a series' array of days, one row for each calendar day.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# MacKinnon (2010) response-surface coefficients for the
# Dickey-Fuller tau statistic with a constant (b0, b1, b2, b3) at 1%, 5%, 10%.
ADF_CRIT_CONSTANT = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}

# MacKinnon (1994) approximate p-value of that statistic: the
# normal distribution of a polynomial in tau, one up to TAU_STAR, one above.
TAU_LEAST, TAU_STAR, TAU_MOST = -18.83, -1.61, 2.74
TAU_SMALL_P = (2.1659, 1.4412, 0.038269)
TAU_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
NORMAL_975 = 1.959963984540054

MIN_DAYS = 8  # of a series that is tested
EXACT_FIT = 1e-12  # share of the variance left by a regression that explains everything


def _own() -> Window:
    return Window.partitionBy("series_id").orderBy("day")


def _placed(daily: DataFrame) -> DataFrame:
    """(series_id, day, value, pos, n): day by day from 0."""
    return daily.select("series_id", "day", F.col("value").cast("double").alias("value")).withColumn(
        "pos", (F.row_number().over(_own()) - 1).cast("int")).withColumn("n", F.count("*").over(Window.partitionBy("series_id")).cast("int"))


def _edges(value: Column, pos: Column, n: Column, most: int) -> Column:
    """Aggregate: (pos, value) of the first and last `most` places, ordered."""
    return F.sort_array(F.collect_list(F.when((pos < most) | (pos >= n - most), F.struct(pos.alias("pos"), value.alias("value")))))


def _lag_sums(value: Column, lagged: str, most: int, where: Column) -> Column:
    """Aggregate: sums of `value` times column `lagged` 0 .. `most` places before,
    over the rows of `where`.  The lags are columns `{lagged}_k`."""
    return F.array(*[F.coalesce(F.sum(F.when(where, value * F.col(f"{lagged}_{k}"))), F.lit(0.0)) for k in range(most + 1)])


def _with_lags(rows: DataFrame, column: str, most: int) -> DataFrame:
    return rows.select("*", *[(F.lag(column, k).over(_own()) if k else F.col(column)).alias(f"{column}_{k}") for k in range(most + 1)])


def lagged_moments(sums: list[float], edge: dict[int, float], n: int, start: int, size: int) -> np.ndarray:
    """Matrix of the sums of v[t-i] * v[t-j] over t = start .. n-1 for i, j up to
    `size` <= start, from the sums over all t and the values at both ends."""
    out = np.empty((size + 1, size + 1))
    for i in range(size + 1):
        for j in range(i, size + 1):
            gap = j - i
            before = sum(edge[u] * edge[u - gap] for u in range(gap, start - i))
            behind = sum(edge[u] * edge[u - gap] for u in range(n - i, n))
            out[i, j] = out[j, i] = sums[gap] - before - behind
    return out


def solve(moments: np.ndarray, target: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Least squares from X'X, X'y and y'y: coefficients, inverse of X'X and the
    sum of squares left.  Columns are brought to one scale first; a combination
    of others gets the least coefficients."""
    scale = np.sqrt(np.maximum(np.diag(moments), 0.0))
    scale[scale == 0] = 1.0
    inverse = np.linalg.pinv(moments / np.outer(scale, scale), rcond=1e-13, hermitian=True) / np.outer(scale, scale)
    beta = inverse @ target
    left = square - 2 * beta @ target + beta @ moments @ beta
    return beta, inverse, max(float(left), 0.0)


# Augmented Dickey-Fuller test.


def max_lag(n: int) -> int:
    return max(0, min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 3))


def adf_p_value(stat: float) -> float:
    if math.isnan(stat):
        return math.nan
    if stat > TAU_MOST:
        return 1.0
    if stat < TAU_LEAST:
        return 0.0
    coefs = TAU_SMALL_P if stat <= TAU_STAR else TAU_LARGE_P
    x = sum(c * stat ** i for i, c in enumerate(coefs))
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def adf_from_sums(n: int, dd: list[float], yd: list[float], yy: float, y: float, edge: dict[int, float]) -> tuple[float, int, int]:
    """Statistic, lag and observations.  With N = n - 1 differences d[t] =
    y[t+1] - y[t]: `dd[k]` is the sum of d[t] * d[t-k], `yd[k]` that of
    y[t] * d[t-k], `yy` and `y` the sums of y[t] squared and y[t], t < N."""
    most, count = max_lag(n), n - 1
    steps = {t: edge[t + 1] - edge[t] for t in edge if t + 1 in edge}

    def regression(lag: int, start: int):
        """Constant, level and `lag` differences against the difference."""
        d = lagged_moments(dd, steps, count, start, lag)
        x = np.empty((lag + 3, lag + 3))  # constant, level, differences at lags 0 .. lag
        x[2:, 2:] = d
        x[0, 0] = count - start
        x[0, 1] = x[1, 0] = y - sum(edge[t] for t in range(start))
        x[1, 1] = yy - sum(edge[t] ** 2 for t in range(start))
        for i in range(lag + 1):
            x[0, 2 + i] = x[2 + i, 0] = edge[count - i] - edge[start - i]
            x[1, 2 + i] = x[2 + i, 1] = yd[i] - sum(edge[t] * steps[t - i] for t in range(i, start))
        return x

    def fit(x: np.ndarray, lag: int):
        use = [0, 1, *range(3, 3 + lag)]
        return solve(x[np.ix_(use, use)], x[use, 2], x[2, 2])

    whole = regression(most, most)
    rows, best = count - most, (math.inf, 0)
    for lag in range(most + 1):
        if rows > lag + 2:
            left = fit(whole, lag)[2]
            exact = left <= EXACT_FIT * whole[2, 2]
            best = min(best, (-math.inf if exact else rows * math.log(left / rows) + 2 * (lag + 2), lag))
    lag = best[1]
    rows, x = count - lag, regression(lag, lag)
    beta, inverse, left = fit(x, lag)
    variance = left / max(rows - lag - 2, 1) * inverse[1, 1]
    known = variance > 0 and left > EXACT_FIT * x[2, 2]
    return (float(beta[1] / math.sqrt(variance)) if known else math.nan), lag, rows


_ADF = pa.struct([("adf_stat", pa.float64()), ("p_value", pa.float64()), ("used_lag", pa.int32()), ("nobs", pa.int32()),
                  ("crit_1", pa.float64()), ("crit_5", pa.float64()), ("crit_10", pa.float64())])


def _adf_solved():
    @arrow_udf("adf_stat double, p_value double, used_lag int, nobs int, crit_1 double, crit_5 double, crit_10 double")
    def solved(n: pa.Array, dd: pa.Array, yd: pa.Array, yy: pa.Array, y: pa.Array, edge: pa.Array) -> pa.Array:
        out = []
        for days, *sums, ends in zip(*(c.to_pylist() for c in (n, dd, yd, yy, y, edge))):
            stat, lag, rows, crit = math.nan, 0, days, [math.nan] * 3
            if days >= MIN_DAYS:
                stat, lag, rows = adf_from_sums(days, *sums, {e["pos"]: e["value"] for e in ends})
                crit = [sum(b / rows ** i for i, b in enumerate(ADF_CRIT_CONSTANT[k])) for k in ("1%", "5%", "10%")]
            out.append((stat, adf_p_value(stat), lag, rows, *crit))
        return pa.StructArray.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_ADF)], fields=list(_ADF))

    return solved


def adf(daily: DataFrame) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant of every series (series_id,
    day, value), lag by AIC.  A series of under MIN_DAYS days, or one that its
    regression explains entirely, has no statistic (NaN)."""
    rows = _placed(daily)
    longest = rows.agg(F.max("n")).first()[0] or 0  # one number
    most = max_lag(longest)
    rows = rows.withColumn("y", F.col("value") - F.avg("value").over(Window.partitionBy("series_id")))  # the constant takes the shift
    rows = _with_lags(rows.withColumn("d", F.lead("y").over(_own()) - F.col("y")), "d", most)
    inner = F.col("d").isNotNull()
    sums = rows.groupBy("series_id").agg(
        F.max("n").alias("n"), _lag_sums(F.col("d"), "d", most, inner).alias("dd"), _lag_sums(F.col("y"), "d", most, inner).alias("yd"),
        F.coalesce(F.sum(F.when(inner, F.col("y") * F.col("y"))), F.lit(0.0)).alias("yy"), F.coalesce(F.sum(F.when(inner, F.col("y"))), F.lit(0.0)).alias("y_sum"),
        _edges(F.col("y"), F.col("pos"), F.col("n"), most + 2).alias("edge"))
    return sums.select("series_id", _adf_solved()("n", "dd", "yd", "yy", "y_sum", "edge").alias("t")).select("series_id", "t.*")


# ARIMA.


def long_order(n: int, p: int, q: int) -> int:
    """Order of the autoregression that estimates the shocks of n values."""
    return min(max(p + q + 2, int(math.floor(10 * math.log10(max(n, 10)) + 0.5))), n // 3)


def stable(coefs: np.ndarray) -> np.ndarray:
    """Shrink the coefficients of 1 - c1 B - c2 B^2 .. until its roots lie
    outside the unit circle, so that recursions stay bounded."""
    for _ in range(200):
        if not len(coefs) or not coefs.any() or np.abs(np.roots(np.concatenate([[1.0], -coefs]))).max() < 0.995:
            break
        coefs = coefs * 0.97 ** np.arange(1, len(coefs) + 1)
    return coefs


def _long_solved(p: int, q: int):
    @arrow_udf("array<double>")
    def solved(n: pa.Array, sums: pa.Array, edge: pa.Array) -> pa.Array:
        """The long autoregression; none for a series too short or constant."""
        out = []
        for count, c, ends in zip(*(x.to_pylist() for x in (n, sums, edge))):
            order = long_order(count, p, q)
            if count < 3 * (p + q + 2) or c[0] <= 0:
                out.append([])
                continue
            m = lagged_moments(c, {e["pos"]: e["value"] for e in ends}, count, order, order)
            out.append(solve(m[1:, 1:], m[1:, 0], m[0, 0])[0].tolist())
        return pa.array(out, pa.list_(pa.float64()))

    return solved


def _arma_solved(p: int, q: int):
    @arrow_udf("array<double>")
    def solved(sums: pa.Array) -> pa.Array:
        """ar and ma coefficients from the products of the value, its p lags and
        q lagged shocks (upper triangle by rows); zeros without sums."""
        out = []
        for s in sums.to_pylist():
            coefs = np.zeros(p + q)
            if s is not None and None not in s:
                m = np.zeros((p + q + 1, p + q + 1))
                m[np.triu_indices(p + q + 1)] = s
                m += np.triu(m, 1).T
                coefs = solve(m[1:, 1:], m[1:, 0], m[0, 0])[0]
            out.append([*stable(coefs[:p]).tolist(), *(-stable(-coefs[p:])).tolist()])
        return pa.array(out, pa.list_(pa.float64()))

    return solved


def _zeros(n: int) -> Column:
    return F.array(*[F.lit(0.0)] * n).cast("array<double>")


def _dot(coefs: Column, first: int, values: Column, n: int) -> Column:
    """coefs[first] * values[0] + .. over n entries."""
    return sum((F.get(coefs, first + i) * F.get(values, i) for i in range(n)), F.lit(0.0))


def _pushed(value: Column, values: Column, n: int) -> Column:
    return F.slice(F.concat(F.array(value), values), 1, n) if n else values


def shocks(xs: Column, coefs: Column, p: int, q: int) -> Column:
    """Array of shocks: x[t] less its prediction from earlier values and shocks,
    which are 0 before the start."""
    def step(state: Column, x: Column) -> Column:
        e = x - _dot(coefs, 0, state["x"], p) - _dot(coefs, p, state["e"], q)
        return F.struct(_pushed(x, state["x"], p).alias("x"), _pushed(e, state["e"], q).alias("e"), F.array_append(state["out"], e).alias("out"))

    empty = F.array().cast("array<double>")
    return F.aggregate(xs, F.struct(_zeros(p).alias("x"), _zeros(q).alias("e"), empty.alias("out")), step, lambda s: s["out"])


def forecast_path(x: Column, e: Column, levels: Column, coefs: Column, mean: Column, p: int, d: int, q: int, steps: int) -> Column:
    """Array of the next `steps` values.  `x` and `e` hold the last p centred
    differences and q shocks, the latest first; `levels` the last value
    differenced d-1, .. 1, 0 times; shocks to come are 0."""
    def step(state: Column, _: Column) -> Column:
        ahead = _dot(coefs, 0, state["x"], p) + _dot(coefs, p, state["e"], q)
        value, raised = ahead + mean, []
        for i in range(d):
            value = F.get(state["levels"], i) + value
            raised.append(value)
        return F.struct(_pushed(ahead, state["x"], p).alias("x"), _pushed(F.lit(0.0), state["e"], q).alias("e"),
                        (F.array(*raised) if d else state["levels"]).alias("levels"), F.array_append(state["out"], value).alias("out"))

    empty = F.array().cast("array<double>")
    start = F.struct(x.alias("x"), e.alias("e"), levels.alias("levels"), empty.alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["out"])


def psi_weights(coefs: Column, p: int, d: int, q: int, steps: int) -> Column:
    """Array of the first `steps` weights of past shocks in the series itself:
    psi[j] = ma[j] + sum of a[i] * psi[j-i], a the autoregression of the
    undifferenced series."""
    whole = [F.lit(1.0), *[-F.get(coefs, i) for i in range(p)]]
    for _ in range(d):
        whole = [a - b for a, b in zip([*whole, F.lit(0.0)], [F.lit(0.0), *whole])]
    back = F.array(*[-c for c in whole[1:]]).cast("array<double>")
    size = p + d
    ma = F.array(F.lit(1.0), *[F.get(coefs, p + j) for j in range(q)]).cast("array<double>")

    def step(state: Column, j: Column) -> Column:
        psi = F.coalesce(F.get(ma, j), F.lit(0.0)) + _dot(back, 0, state["last"], size)
        return F.struct(_pushed(psi, state["last"], size).alias("last"), F.array_append(state["out"], psi).alias("out"))

    empty = F.array().cast("array<double>")
    return F.aggregate(F.sequence(F.lit(0), F.lit(steps - 1)), F.struct(_zeros(size).alias("last"), empty.alias("out")), step, lambda s: s["out"])


def _running_sum(values: Column) -> Column:
    empty = F.array().cast("array<double>")
    return F.aggregate(values, F.struct(F.lit(0.0).alias("sum"), empty.alias("out")),
                       lambda s, v: F.struct((s["sum"] + v).alias("sum"), F.array_append(s["out"], s["sum"] + v).alias("out")), lambda s: s["out"])


def arima_fit(daily: DataFrame, order: tuple[int, int, int] = (3, 1, 2)) -> DataFrame:
    """One row for each series (series_id, day, value) of more than d + 1 days:
    coefs (p autoregressive, q moving-average ones), mean of the d-fold
    difference, sigma2, and arrays by day: days, ys, and xs and shocks (d
    shorter).  A series too short for the order, or constant, has coefficients
    0, a drift only."""
    p, d, q = order
    spark = daily.sparkSession
    tasks = 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)  # not that of the rows, or it has no effect
    rows = _placed(daily.repartition(tasks, "series_id"))  # little data and much work: AQE would make it one task
    w = F.col("value")
    for _ in range(d):
        rows = rows.withColumn("w", w)
        w = F.col("w") - F.lag("w").over(_own())
    rows = rows.withColumn("w", w)
    whole = Window.partitionBy("series_id")
    rows = (rows.withColumn("mean", F.avg("w").over(whole)).withColumn("x", F.col("w") - F.col("mean"))
            .withColumn("at", F.col("pos") - d).withColumn("count", F.col("n") - d).where(F.col("n") > d + 1))
    longest = rows.agg(F.max("count")).first()[0] or 0  # one number
    most = max(1, long_order(longest, p, q), p)
    lagged = _with_lags(rows, "x", most)
    known = F.col("x").isNotNull()
    sums = lagged.groupBy("series_id").agg(F.max("count").alias("count"), _lag_sums(F.col("x"), "x", most, known).alias("sums"),
                                           _edges(F.col("x"), F.when(known, F.col("at")), F.col("count"), most + 1).alias("edge"))
    long = sums.select("series_id", _long_solved(p, q)("count", "sums", "edge").alias("long"))

    # shocks of the long autoregression, and the regression on them
    lagged = lagged.join(long, "series_id")
    reach = F.size("long")
    guess = sum((F.coalesce(F.get("long", k - 1), F.lit(0.0)) * F.coalesce(F.col(f"x_{k}"), F.lit(0.0)) for k in range(1, most + 1)), F.lit(0.0))
    lagged = lagged.withColumn("e", F.when((reach > 0) & (F.col("at") >= reach), F.col("x") - guess))
    terms = [F.col("x"), *[F.col(f"x_{i}") for i in range(1, p + 1)], *[F.col(f"e_{j}") for j in range(1, q + 1)]]
    used = (reach > 0) & (F.col("at") >= F.greatest(F.lit(p), F.lit(q) + (reach if q else F.lit(0))))
    pairs = [(i, j) for i in range(p + q + 1) for j in range(i, p + q + 1)]
    regression = _with_lags(lagged, "e", q).groupBy("series_id").agg(
        F.array(*[F.sum(F.when(used, terms[i] * terms[j])) for i, j in pairs]).alias("moments"),
        F.max(reach).alias("reach"), F.first("mean", ignorenulls=True).alias("mean"),
        F.sort_array(F.collect_list(F.struct("day", "value", "x"))).alias("series"))  # a day each
    fit = regression.select("series_id", "reach", "mean", _arma_solved(p, q)("moments").alias("coefs"),
                            F.col("series.day").alias("days"), F.col("series.value").alias("ys"),
                            F.filter("series.x", lambda v: v.isNotNull()).alias("xs"))
    if q:  # once more, with the shocks of this fit
        fit = fit.withColumn("shocks", shocks(F.col("xs"), F.col("coefs"), p, q))
        start = F.greatest(F.lit(p), F.lit(q) + F.col("reach"))
        length = F.size("xs") - start

        def part(i: int) -> Column:
            array, lag = (F.col("xs"), i) if i <= p else (F.col("shocks"), i - p)
            return F.slice(array, start - lag + 1, F.greatest(length, F.lit(0)))

        products = F.array(*[F.aggregate(F.zip_with(part(i), part(j), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v) for i, j in pairs])
        moments = F.when((F.col("reach") > 0) & (length > 0), products)
        fit = fit.withColumn("coefs", _arma_solved(p, q)(moments))
    fit = fit.withColumn("shocks", shocks(F.col("xs"), F.col("coefs"), p, q))
    squares = F.aggregate(F.slice("shocks", p + 1, F.greatest(F.size("shocks") - p, F.lit(0))), F.lit(0.0), lambda s, v: s + v * v)
    return fit.withColumn("sigma2", squares / F.greatest(F.size("xs") - (2 * p + q + 1), F.lit(1))).drop("reach")


def arima(daily: DataFrame, order: tuple[int, int, int] = (3, 1, 2), steps: int = 25) -> DataFrame:
    """TS5/TS6 for every series (series_id, day, value): rows of kind 'fitted'
    (step counts the days; the first d have no mean) and 'forecast' (step 1 ..)
    with standard error and 95% interval."""
    p, d, q = order
    fit = arima_fit(daily, order)

    def latest(array: str, n: int) -> Column:
        return F.slice(F.concat(F.reverse(array), _zeros(n)), 1, n) if n else _zeros(0)

    last = [F.element_at("ys", -1 - i) for i in range(d)]
    levels = []
    for k in range(d):  # differences of order 0, 1, .. at the end
        levels.insert(0, last[0])
        last = [a - b for a, b in zip(last, last[1:])]
    weights = _running_sum(F.transform(psi_weights(F.col("coefs"), p, d, q, steps), lambda v: v * v))
    fit = fit.select(
        "series_id", "days", "ys", "shocks",
        forecast_path(latest("xs", p), latest("shocks", q), F.array(*levels).cast("array<double>"), F.col("coefs"), F.col("mean"), p, d, q, steps).alias("ahead"),
        F.get(F.transform(F.array("sigma2"), lambda sigma2: F.transform(weights, lambda v: F.sqrt(sigma2 * v))), 0).alias("errors"))  # sigma2 evaluated once
    fitted = F.transform("days", lambda day, i: F.struct(
        F.lit("fitted").alias("kind"), i.alias("step"), day.alias("day"), (F.get("ys", i) - F.get("shocks", i - d)).alias("mean"), F.lit(None).cast("double").alias("std_error")))
    ahead = F.transform(F.arrays_zip("ahead", "errors"), lambda x, i: F.struct(  # not F.get("errors", i), which evaluates the array for every step
        F.lit("forecast").alias("kind"), (i + 1).alias("step"), F.date_add(F.element_at("days", -1), i + 1).alias("day"), x["ahead"].alias("mean"), x["errors"].alias("std_error")))
    rows = fit.select("series_id", F.explode(F.concat(fitted, ahead)).alias("r")).select("series_id", "r.*")
    return rows.select("*", (F.col("mean") - NORMAL_975 * F.col("std_error")).alias("lower"), (F.col("mean") + NORMAL_975 * F.col("std_error")).alias("upper"))
