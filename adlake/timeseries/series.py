"""Many-series daily rollups and native window statistics (TS1, TS2, TS4,
TS7, WI7-WI9).

Every series is one ``series_id``; every statistic is a window partitioned by
it.  The input is always a *daily rollup* (one row per series per calendar
day), so the rows of one window partition are bounded by the calendar, not by
the raw event volume: a user with a third of all events still has one row per
day here.  Values are carried as integer cents so sums are exact and
independent of row order; doubles appear only in the final division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cents(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 100).cast("bigint")


def wide(c: Column | str) -> Column:
    """An integer whose products and sums of products stay exact: up to 19
    digits, so a product has up to 38."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def daily_rollup(df: DataFrame, series: str, ts: str, value: str) -> DataFrame:
    """Σ value (in cents) per series per day; partial aggregation map-side."""
    return (df.select(F.col(series).alias("series_id"), F.to_date(ts).alias("day"),
                      cents(value).alias("c"))
            .groupBy("series_id", "day").agg(F.sum("c").alias("cents")))


def dense_daily(df: DataFrame, series: str, ts: str, value: str) -> DataFrame:
    """Daily rollup re-indexed to every calendar day between the series' first
    and last day (missing days = 0).  The calendar is generated per series with
    ``sequence`` + ``explode`` (its size is the series length), then equi-joined
    to the rollup: no cross join."""
    daily = daily_rollup(df, series, ts, value)
    bounds = daily.groupBy("series_id").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    cal = bounds.select("series_id", F.explode(F.sequence("lo", "hi")).alias("day"))
    return (cal.join(daily, ["series_id", "day"], "left")
            .select("series_id", "day", F.coalesce("cents", F.lit(0)).alias("cents")))


def _w(order="day"):
    return Window.partitionBy("series_id").orderBy(order)


def rolling_stats(s: DataFrame, n: int = 12) -> DataFrame:
    """Trailing mean and sample std over ``n`` rows, NULL until ``n`` rows
    exist (pandas ``rolling(n)``)."""
    w = _w().rowsBetween(-(n - 1), 0)
    c = wide("cents")
    k, s1, s2 = F.count("*").over(w), F.sum(c).over(w), F.sum(c * c).over(w)
    full = k == n
    mean = F.when(full, s1.cast("double") / float(n * 100))
    spread = F.lit(n).cast("decimal(3,0)") * s2 - wide(s1) * wide(s1)
    std = F.when(full, F.sqrt(spread.cast("double") / float(n * (n - 1))) / 100.0)
    return s.select("series_id", "day", (F.col("cents") / 100.0).alias("value"),
                    mean.alias("rolling_mean"), std.alias("rolling_std"))


def centered_ma(s: DataFrame, period: int = 12) -> DataFrame:
    """Centred moving average as in classical decomposition.  Even period:
    2 x period MA (half weights at both ends); odd: plain period-point MA.
    NULL where the window is incomplete."""
    h = period // 2
    w = _w().rowsBetween(-h, h)
    k, tot = F.count("*").over(w), F.sum("cents").over(w)
    if period % 2 == 0:
        ends = F.lag("cents", h).over(_w()) + F.lead("cents", h).over(_w())
        trend = F.when(k == 2 * h + 1, (F.lit(2) * tot - ends).cast("double") / float(2 * period * 100))
    else:
        trend = F.when(k == period, tot.cast("double") / float(period * 100))
    return s.select("series_id", "day", (F.col("cents") / 100.0).alias("value"), trend.alias("trend"))


def first_difference(s: DataFrame, lag: int = 1) -> DataFrame:
    prev = F.lag("cents", lag).over(_w())
    return s.select("series_id", "day", (F.col("cents") / 100.0).alias("value"),
                    ((F.col("cents") - prev) / 100.0).alias("diff"))


def time_split(s: DataFrame, skip: int = 3, train_frac: float = 0.9) -> DataFrame:
    """Positional split per series, ``x[skip:cut]`` / ``x[cut:]`` with
    ``cut = floor(n*frac)``: positions before ``skip`` that are not in the
    test slice are dropped."""
    pos = F.row_number().over(_w()) - 1
    n = F.count("*").over(Window.partitionBy("series_id"))
    cut = F.floor(n.cast("double") * train_frac)
    t = s.select("series_id", "day", "cents", pos.alias("pos"), cut.alias("cut"))
    test = F.col("pos") >= F.col("cut")
    return (t.where(test | (F.col("pos") >= skip))
            .select("series_id", "day", (F.col("cents") / 100.0).alias("value"), "pos",
                    F.when(test, F.lit("test")).otherwise(F.lit("train")).alias("split")))


def seasonal_decompose(s: DataFrame, period: int = 7) -> DataFrame:
    """Additive classical decomposition per series: trend = centred MA,
    seasonal = per-phase mean of the detrended values minus the mean of those
    phase means, residual = value - trend - seasonal (NULL at the ends).

    Fully native: windows + one grouped aggregate per (series, phase) joined
    back; the phase table has ``period`` rows per series."""
    w = _w()
    t = centered_ma(s, period).withColumn("phase", ((F.row_number().over(w) - 1) % period).cast("int"))
    t = t.withColumn("detrended", F.col("value") - F.col("trend"))
    ph = t.groupBy("series_id", "phase").agg(F.avg("detrended").alias("_pm"))
    ph = ph.withColumn("_pm", F.col("_pm").cast("decimal(38,10)"))
    grand = ph.groupBy("series_id").agg((F.sum("_pm").cast("double") / float(period)).alias("_g"))
    seas = ph.join(grand, "series_id").select("series_id", "phase", (F.col("_pm").cast("double") - F.col("_g")).alias("seasonal"))
    out = t.join(seas, ["series_id", "phase"], "left")
    r6 = lambda c: F.round(c.cast("decimal(38,10)"), 6).cast("double")
    return out.select("series_id", "day", "value", r6(F.col("trend")).alias("trend"),
                      r6(F.col("seasonal")).alias("seasonal"),
                      r6(F.col("value") - F.col("trend") - F.col("seasonal")).alias("resid"))


def acf(s: DataFrame, nlags: int = 20) -> DataFrame:
    """Autocorrelation for lags 1..nlags per series, exact: with n values
    and sum S, the centred values are carried as the integers n*c - S, so
    every sum of products is an integer and the ratio is order-independent.
    Output is long: (series_id, lag, acf, n, band) with band = 1.96/sqrt(n)."""
    whole = Window.partitionBy("series_id")
    d = s.select("series_id", "day", (F.count("*").over(whole) * F.col("cents") - F.sum("cents").over(whole)).alias("d"),
                 F.count("*").over(whole).alias("n"))
    w = _w()
    d = d.withColumn("d", wide("d"))
    lagged = d.select("series_id", "n", "d", *[(F.col("d") * F.lag("d", k).over(w)).alias(f"p{k}")
                                               for k in range(1, nlags + 1)])
    g = lagged.groupBy("series_id").agg(F.first("n").alias("n"), F.sum(F.col("d") * F.col("d")).alias("den"),
                                        *[F.sum(f"p{k}").alias(f"p{k}") for k in range(1, nlags + 1)])
    long = g.select("series_id", "n", "den", F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"p{k}").alias("num"))
                                                              for k in range(1, nlags + 1)])).alias("x"))
    return long.select("series_id", F.col("x.lag").alias("lag"),
                       F.when(F.col("den") > 0, F.coalesce(F.col("x.num"), F.lit(0)).cast("double") / F.col("den").cast("double")).alias("acf"),
                       F.col("n").cast("bigint").alias("n"),
                       (F.lit(1.96) / F.sqrt(F.col("n").cast("double"))).alias("band"))


def pacf(s: DataFrame, nlags: int = 20) -> DataFrame:
    """Partial autocorrelations for lags 1..min(nlags, n - 2) per series:
    Durbin-Levinson on adjusted autocorrelations (sums over n - k products
    divided by n - k).  A constant series has NULL.  Rounded to 6 decimals."""
    rho = acf(s, nlags).groupBy("series_id").agg(
        F.max("n").alias("n"),
        F.transform(F.sort_array(F.collect_list(F.struct("lag", F.coalesce("acf", F.lit(float("nan"))).alias("acf"), "n"))),
                    lambda r: F.when(r["lag"] < r["n"], r["acf"] * r["n"] / (r["n"] - r["lag"]))).alias("rho"))  # nlags entries
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)

    def step(state: Column, k: Column) -> Column:
        phi, known = state["phi"], F.slice("rho", 1, k - 1)
        below = 1.0 - dot(phi, known)
        last = F.when(below != 0, (F.get("rho", k - 1) - dot(phi, F.reverse(known))) / below)
        return F.struct(F.array_append(F.zip_with(phi, F.reverse(phi), lambda a, b: a - last * b), last).alias("phi"),
                        F.array_append(state["out"], last).alias("out"))

    empty = F.array().cast("array<double>")
    lags = F.least(F.lit(nlags), F.col("n") - 2).cast("int")
    values = F.when(lags >= 1, F.aggregate(F.sequence(F.lit(1), lags), F.struct(empty.alias("phi"), empty.alias("out")), step, lambda t: t["out"]))
    long = rho.select("series_id", F.posexplode(values).alias("i", "v"))
    return long.select("series_id", (F.col("i") + 1).alias("lag"),
                       F.when(~F.isnan("v"), F.round(F.col("v").cast("decimal(38,10)"), 6).cast("double")).alias("pacf"))
