"""Registered keys for aggregations, windows, sorts, set operations and
reshaping (§2.5-2.9)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from adlake.functions.core import money_sum, sunday_week
from adlake.operators import relational as R
from adlake.plans.driver_views import sql_week
from adlake.plans.keys_relational import EVENTS_AS_OF, _LEFT_BUILDING_SQL, _left_building
from adlake.plans.registry import register
from adlake.sources.tables import Tables
from adlake.timeseries import series as TS


def _t(spark, sf):
    return Tables(spark, sf)


def round_half_up(c, scale: int):
    """ROUND(x, n) half away from zero on the decimal value of ``x``."""
    return F.round(c.cast("decimal(38,10)"), scale).cast("double")


SQL_DENSE_DAILY = """
daily AS (
  SELECT user_id AS series_id, CAST(ts AS DATE) AS day,
         SUM(CAST(round(value * 100) AS BIGINT)) AS cents
  FROM events GROUP BY 1, 2),
bounds AS (SELECT series_id, min(day) AS lo, max(day) AS hi FROM daily GROUP BY 1),
cal AS (SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds),
series AS (SELECT c.series_id, c.day, COALESCE(d.cents, 0) AS cents
           FROM cal c LEFT JOIN daily d ON c.series_id = d.series_id AND c.day = d.day)"""


def events_daily(spark, sf):
    return TS.dense_daily(_t(spark, sf).events, "user_id", "ts", "value")


# ------------------------------------------------------------ aggregates

@register("monthly_sums", """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderstatus,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
  count(*) AS n_orders, CAST(SUM(o_custkey) AS BIGINT) AS sum_custkey
FROM orders GROUP BY 1, 2, 3
""", "AG1,AG6,SF9")
def monthly_sums(spark, sf):
    o = _t(spark, sf).orders
    return (o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                      "o_orderstatus")
            .agg(money_sum("o_totalprice").alias("total_price"), F.count("*").alias("n_orders"),
                 F.sum("o_custkey").alias("sum_custkey")))


@register("group_count", """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1
""", "AG2")
def group_count(spark, sf):
    return _t(spark, sf).orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@register("sum_coalesce", f"""
SELECT o_orderstatus, CAST(SUM(CAST(COALESCE(c_acctbal, 0) AS DECIMAL(18,2))) AS DOUBLE) AS bal,
       count(*) AS n
FROM {_LEFT_BUILDING_SQL} j GROUP BY 1
""", "AG4,SF1")
def sum_coalesce(spark, sf):
    j = _left_building(spark, sf)
    return j.groupBy("o_orderstatus").agg(
        money_sum(F.coalesce("c_acctbal", F.lit(0.0))).alias("bal"), F.count("*").alias("n"))


@register("any_value_min", """
SELECT l_orderkey, min(l_returnflag) AS any_flag, min(l_shipdate) AS any_shipdate, count(*) AS n_lines
FROM lineitem GROUP BY 1
""", "AG5")
def any_value_min(spark, sf):
    return _t(spark, sf).lineitem.groupBy("l_orderkey").agg(
        F.min("l_returnflag").alias("any_flag"), F.min("l_shipdate").alias("any_shipdate"),
        F.count("*").alias("n_lines"))


@register("distinct_rows", """
SELECT DISTINCT c_nationkey, c_mktsegment FROM customer
""", "AG7,AG8")
def distinct_rows(spark, sf):
    return _t(spark, sf).customer.select("c_nationkey", "c_mktsegment").distinct()


@register("conditional_sums", f"""
SELECT user_id,
  CAST(SUM(CASE WHEN CAST(ts AS DATE) = DATE '{EVENTS_AS_OF}' THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS today,
  CAST(SUM(CASE WHEN CAST(ts AS DATE) < DATE '{EVENTS_AS_OF}'
                 AND dayofweek(ts) = dayofweek(DATE '{EVENTS_AS_OF}') THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS same_weekday,
  CAST(coalesce(SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE CAST(ts AS DATE) = DATE '{EVENTS_AS_OF}'), 0) AS DOUBLE) AS budget,
  max(event_type) AS name
FROM events WHERE CAST(ts AS DATE) >= DATE '{EVENTS_AS_OF}' - INTERVAL 28 DAY
GROUP BY 1
""", "AG9")
def conditional_sums(spark, sf):
    ev = _t(spark, sf).events
    d = F.to_date("ts")
    asof = F.to_date(F.lit(EVENTS_AS_OF))
    zero = F.lit(0).cast("decimal(18,2)")
    v = F.col("value").cast("decimal(18,2)")
    return (ev.where(d >= F.date_sub(asof, 28)).groupBy("user_id").agg(
        F.sum(F.when(d == asof, v).otherwise(zero)).cast("double").alias("today"),
        F.sum(F.when((d < asof) & (F.dayofweek(d) == F.dayofweek(asof)), v).otherwise(zero))
         .cast("double").alias("same_weekday"),
        F.sum(F.when(d == asof, v).otherwise(zero)).cast("double").alias("budget"),  # the current day's only
        F.max("event_type").alias("name")))


@register("value_counts", """
SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1
""", "AG10")
def value_counts(spark, sf):
    return R.value_counts(_t(spark, sf).events, "event_type")


_DAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


@register("crosstab", """
SELECT event_type,
  """ + ",\n  ".join(
    f"CAST(NULLIF(count(*) FILTER (WHERE dayname(ts) = '{d}'), 0) AS BIGINT) AS {d}" for d in _DAYS) + """
FROM events GROUP BY 1
""", "AG11,RS5")
def crosstab(spark, sf):
    ev = _t(spark, sf).events.select("event_type", F.date_format("ts", "EEEE").alias("weekday"))
    return R.crosstab(ev, "event_type", "weekday", _DAYS)


@register("facet_count", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000
GROUP BY 1, 2
""", "AG12")
def facet_count(spark, sf):
    o = _t(spark, sf).orders
    return (o.where(F.col("o_totalprice") > 100000).groupBy("o_orderstatus", "o_orderpriority")
            .agg(F.count("*").alias("n")))


@register("null_counts", f"""
SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(o_custkey) AS o_custkey,
  count(*) - count(o_totalprice) AS o_totalprice, count(*) - count(o_orderstatus) AS o_orderstatus,
  count(*) - count(c_name) AS c_name, count(*) - count(c_acctbal) AS c_acctbal,
  count(*) - count(c_mktsegment) AS c_mktsegment
FROM {_LEFT_BUILDING_SQL} j
""", "AG13,ML1")
def null_counts(spark, sf):
    return R.null_counts(_left_building(spark, sf))


@register("adjacency", """
SELECT 'customer' AS side, c_custkey AS vertex, 0 AS page, list_sort(list(c_nationkey)) AS neighbours
FROM customer GROUP BY c_custkey
UNION ALL
SELECT 'nation' AS side, c_nationkey AS vertex, c_custkey // 1024 AS page,
       list_sort(list(c_custkey)) AS neighbours
FROM customer GROUP BY c_nationkey, c_custkey // 1024
""", "AG15")
def adjacency(spark, sf):
    from adlake.operators.graph import adjacency_both
    c = _t(spark, sf).customer
    return adjacency_both(c, "c_custkey", "c_nationkey", "customer", "nation")


@register("even_allocation", """
WITH daily AS (
  SELECT CAST(o_orderdate AS DATE) AS d, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS traffic
  FROM orders GROUP BY 1),
detail AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber < 7 THEN CAST(l_shipdate AS DATE) END AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, detail.d, daily.traffic / count(*) OVER (PARTITION BY detail.d) AS allocated
FROM detail LEFT JOIN daily ON detail.d = daily.d
""", "AG16")
def even_allocation(spark, sf):
    from adlake.operators.allocation import even_allocation as ea
    t = _t(spark, sf)
    daily = (t.orders.groupBy(F.to_date("o_orderdate").alias("d"))
             .agg(money_sum("o_totalprice").alias("traffic")))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") < 7, F.to_date("l_shipdate")).alias("d"))
    return ea(rows, daily, ["d"], {"traffic": "allocated"})


@register("ratio_rounded", """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, o_orderpriority,
  CAST(round(CAST(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS DECIMAL(38,10)), 2) AS DOUBLE)
    AS avg_price
FROM orders GROUP BY 1, 2, 3
""", "AG17,SF13")
def ratio_rounded(spark, sf):
    o = _t(spark, sf).orders
    g = o.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                  "o_orderpriority").agg(money_sum("o_totalprice").alias("s"), F.count("*").alias("n"))
    return g.select("year", "month", "o_orderpriority",
                    round_half_up(F.try_divide(F.col("s"), F.col("n")), 2).alias("avg_price"))


# --------------------------------------------------------------- windows

@register("latest_per_key", """
SELECT user_id, ts, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""", "WI1")
def latest_per_key(spark, sf):
    ev = _t(spark, sf).events
    return R.latest_per_key(ev, ["user_id"], "ts", payload=["event_id", "event_type", "value"])


@register("latest_per_key_week", f"""
SELECT user_id, year(ts) AS year, {sql_week('CAST(ts AS DATE)')} AS week, ts, event_id, event_type
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, year(ts), {sql_week('CAST(ts AS DATE)')}
                           ORDER BY ts DESC, event_id DESC) = 1
""", "WI2,SF9")
def latest_per_key_week(spark, sf):
    ev = _t(spark, sf).events.select("user_id", F.year("ts").alias("year"),
                                     sunday_week(F.to_date("ts")).alias("week"), "ts", "event_id",
                                     "event_type")
    return R.latest_per_key(ev, ["user_id", "year", "week"], "ts", payload=["event_id", "event_type"])


@register("dedup_any", """
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1
""", "WI3,S4")
def dedup_any(spark, sf):
    li = _t(spark, sf).lineitem
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in li.columns if c not in keys]
    out = R.pick_per_key(li, keys, rest[:1], latest=False, payload=rest[1:])
    return out.select(*li.columns)


_PRIORITY_SQL = """
WITH src AS (
  SELECT l_orderkey AS orderkey, l_linestatus AS status, 1 AS priority FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT o_orderkey, o_orderstatus, 2 FROM orders)
SELECT orderkey, status, priority FROM src
QUALIFY row_number() OVER (PARTITION BY orderkey ORDER BY priority, status) = 1
"""


@register("priority_pick", _PRIORITY_SQL, "WI4,SE3")
def priority_pick(spark, sf):
    t = _t(spark, sf)
    a = t.lineitem.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linestatus").alias("status"), F.lit(1).alias("priority"))
    b = t.orders.select(F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"),
                        F.lit(2).alias("priority"))
    return R.first_by_priority(a.unionByName(b), ["orderkey"], ["priority"], payload=["status"]).select(
        "orderkey", "status", "priority")


@register("union_dedup", """
WITH src AS (
  SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS d, 'orders' AS source FROM orders
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), 'events' FROM events)
SELECT id, d, source FROM src
QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, source) = 1
""", "SE2,WI3")
def union_dedup(spark, sf):
    t = _t(spark, sf)
    a = t.orders.select(F.col("o_custkey").alias("id"), F.to_date("o_orderdate").alias("d"),
                        F.lit("orders").alias("source"))
    b = t.events.select(F.col("user_id").alias("id"), F.to_date("ts").alias("d"), F.lit("events").alias("source"))
    return R.pick_per_key(a.unionByName(b), ["id"], ["d"], latest=False, payload=["source"]).select(
        "id", "d", "source")


@register("window_after_group", """
SELECT l_orderkey, l_partkey, qty,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY qty DESC, l_partkey) AS rn
FROM (SELECT l_orderkey, l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS qty FROM lineitem GROUP BY 1, 2) g
""", "WI5")
def window_after_group(spark, sf):
    g = (_t(spark, sf).lineitem.groupBy("l_orderkey", "l_partkey")
         .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("qty")))
    w = Window.partitionBy("l_orderkey").orderBy(F.col("qty").desc(), "l_partkey")
    return g.select("l_orderkey", "l_partkey", "qty", F.row_number().over(w).cast("bigint").alias("rn"))


@register("first_value_priority", """
SELECT l_partkey, l_suppkey AS vendor,
  CASE WHEN l_returnflag = 'N' THEN 'No' ELSE 'Yes' END AS automated
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber, l_suppkey, l_returnflag) = 1
""", "WI6")
def first_value_priority(spark, sf):
    li = _t(spark, sf).lineitem
    first = R.first_by_priority(li, ["l_partkey"], ["l_linenumber"], payload=["l_suppkey", "l_returnflag"])
    return first.select("l_partkey", F.col("l_suppkey").alias("vendor"),
                        F.when(F.col("l_returnflag") == "N", F.lit("No")).otherwise(F.lit("Yes")).alias("automated"))


@register("monthly_totals_per_row", """
WITH m AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m,
                  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS month_total, count(*) AS month_n
           FROM orders GROUP BY 1, 2)
SELECT o.o_orderkey, m.month_total, m.month_n
FROM orders o LEFT JOIN m ON year(o.o_orderdate) = m.y AND month(o.o_orderdate) = m.m
""", "WI10")
def monthly_totals_per_row(spark, sf):
    o = _t(spark, sf).orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"),
                                    F.month("o_orderdate").alias("m"))
    out = R.attach_group_totals(o, ["y", "m"], {"month_total": money_sum("o_totalprice"),
                                               "month_n": F.count("*")})
    return out.select("o_orderkey", "month_total", "month_n")


@register("rolling_stats", f"""
WITH {SQL_DENSE_DAILY}
SELECT series_id, day, cents / 100.0 AS value,
  CASE WHEN count(*) OVER w = 12 THEN CAST(SUM(cents) OVER w AS DOUBLE) / 1200.0 END AS rolling_mean,
  CASE WHEN count(*) OVER w = 12 THEN sqrt(CAST(12 * SUM(cents * cents) OVER w - SUM(cents) OVER w * SUM(cents) OVER w AS DOUBLE) / 132.0) / 100.0 END AS rolling_std
FROM series
WINDOW w AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
""", "WI7,TS1")
def rolling_stats(spark, sf):
    return TS.rolling_stats(events_daily(spark, sf), 12)


@register("centered_ma", f"""
WITH {SQL_DENSE_DAILY}
SELECT series_id, day, cents / 100.0 AS value,
  CASE WHEN count(*) OVER w = 13 THEN
    CAST(2 * SUM(cents) OVER w - (lag(cents, 6) OVER o + lead(cents, 6) OVER o) AS DOUBLE) / 2400.0 END AS trend
FROM series
WINDOW w AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING),
       o AS (PARTITION BY series_id ORDER BY day)
""", "WI8")
def centered_ma(spark, sf):
    return TS.centered_ma(events_daily(spark, sf), 12)


@register("first_difference", f"""
WITH {SQL_DENSE_DAILY}
SELECT series_id, day, cents / 100.0 AS value,
  (cents - lag(cents, 1) OVER (PARTITION BY series_id ORDER BY day)) / 100.0 AS diff
FROM series
""", "WI9")
def first_difference(spark, sf):
    return TS.first_difference(events_daily(spark, sf))


@register("time_split", f"""
WITH {SQL_DENSE_DAILY},
p AS (SELECT series_id, day, cents, row_number() OVER (PARTITION BY series_id ORDER BY day) - 1 AS pos,
             floor(CAST(count(*) OVER (PARTITION BY series_id) AS DOUBLE) * CAST(0.9 AS DOUBLE)) AS cut
      FROM series)
SELECT series_id, day, cents / 100.0 AS value, pos, CASE WHEN pos >= cut THEN 'test' ELSE 'train' END AS split
FROM p WHERE pos >= cut OR pos >= 3
""", "SO4,TS7")
def time_split(spark, sf):
    return TS.time_split(events_daily(spark, sf)).withColumn("pos", F.col("pos").cast("bigint"))


# ----------------------------------------------------------------- set ops

@register("union_tagged", """
SELECT o_orderkey AS k, o_totalprice AS amount, 'order' AS source, CAST(NULL AS BIGINT) AS partkey FROM orders
UNION ALL
SELECT l_orderkey, l_extendedprice, 'line', l_partkey FROM lineitem
""", "SE1,PR2,PR3")
def union_tagged(spark, sf):
    t = _t(spark, sf)
    a = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("amount"))
    b = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_extendedprice").alias("amount"),
                          F.col("l_partkey").alias("partkey"))
    return R.union_tagged([(a, {"source": "order"}), (b, {"source": "line"})])


@register("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
""", "SE4")
def union_by_name(spark, sf):
    t = _t(spark, sf)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                          F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
                          F.col("s_suppkey").alias("id"))
    return R.union_all_by_name([a, b])


# ----------------------------------------------------------------- reshape

@register("unpivot_wide", """
SELECT l_orderkey, l_linenumber, variable, value FROM (
  SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_extendedprice AS price,
         CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS tax FROM lineitem)
UNPIVOT INCLUDE NULLS (value FOR variable IN (quantity, price, tax))
""", "RS1")
def unpivot_wide(spark, sf):
    li = _t(spark, sf).lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"), F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"))
    return R.unpivot_wide(li, ["l_orderkey", "l_linenumber"], ["quantity", "price", "tax"])


@register("chunk_groups", """
SELECT p_partkey, p_name, CAST(floor((row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1) / 3) AS BIGINT) AS batch_id, p_type
FROM part
""", "RS6")
def chunk_groups(spark, sf):
    from adlake.operators.reshape import chunk_groups as cg
    return cg(_t(spark, sf).part.select("p_partkey", "p_name", "p_type"), ["p_type"], "p_partkey", 3)


@register("nth_rows_to_columns", """
SELECT l_orderkey,
  max(CASE WHEN rn = 1 THEN l_partkey END) AS slot1,
  max(CASE WHEN rn = 2 THEN l_partkey END) AS slot2,
  max(CASE WHEN rn = 3 THEN l_partkey END) AS slot3
FROM (SELECT l_orderkey, l_partkey,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS rn FROM lineitem) r
WHERE rn <= 3 GROUP BY 1
""", "RS4,JO7,FI12")
def nth_rows_to_columns(spark, sf):
    return R.nth_rows_to_columns(_t(spark, sf).lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey"],
                                 "l_partkey", 3)


@register("seasonal_decompose", f"""
WITH {SQL_DENSE_DAILY},
t AS (SELECT series_id, day, cents / 100.0 AS value,
        CASE WHEN count(*) OVER w = 7 THEN CAST(SUM(cents) OVER w AS DOUBLE) / 700.0 END AS trend,
        CAST((row_number() OVER o - 1) % 7 AS INTEGER) AS phase
      FROM series
      WINDOW w AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
             o AS (PARTITION BY series_id ORDER BY day)),
ph AS (SELECT series_id, phase, CAST(avg(value - trend) AS DECIMAL(38,10)) AS pm FROM t GROUP BY 1, 2),
g AS (SELECT series_id, CAST(SUM(pm) AS DOUBLE) / 7.0 AS gm FROM ph GROUP BY 1),
seas AS (SELECT ph.series_id, phase, CAST(pm AS DOUBLE) - gm AS seasonal FROM ph JOIN g ON ph.series_id = g.series_id)
SELECT t.series_id, day, value,
  CAST(round(CAST(trend AS DECIMAL(38,10)), 6) AS DOUBLE) AS trend,
  CAST(round(CAST(seasonal AS DECIMAL(38,10)), 6) AS DOUBLE) AS seasonal,
  CAST(round(CAST(value - trend - seasonal AS DECIMAL(38,10)), 6) AS DOUBLE) AS resid
FROM t LEFT JOIN seas ON t.series_id = seas.series_id AND t.phase = seas.phase
""", "TS2,WI8")
def seasonal_decompose(spark, sf):
    return TS.seasonal_decompose(events_daily(spark, sf), 7)


@register("acf", f"""
WITH {SQL_DENSE_DAILY},
d AS (SELECT series_id, day, count(*) OVER (PARTITION BY series_id) * cents - SUM(cents) OVER (PARTITION BY series_id) AS d,
             count(*) OVER (PARTITION BY series_id) AS n FROM series),
g AS (SELECT series_id, any_value(n) AS n, SUM(CAST(d AS HUGEINT) * d) AS den FROM d GROUP BY 1),
x AS (SELECT a.series_id, k AS lag, SUM(CAST(a.d AS HUGEINT) * b.d) AS num
      FROM (SELECT series_id, day, d, row_number() OVER (PARTITION BY series_id ORDER BY day) AS pos FROM d) a
      CROSS JOIN range(1, 21) r(k)
      LEFT JOIN (SELECT series_id, d, row_number() OVER (PARTITION BY series_id ORDER BY day) AS pos FROM d) b
        ON a.series_id = b.series_id AND b.pos = a.pos - k
      GROUP BY 1, 2)
SELECT x.series_id, CAST(x.lag AS INTEGER) AS lag,
  CASE WHEN g.den > 0 THEN CAST(COALESCE(x.num, 0) AS DOUBLE) / CAST(g.den AS DOUBLE) END AS acf,
  CAST(g.n AS BIGINT) AS n, 1.96 / sqrt(CAST(g.n AS DOUBLE)) AS band
FROM x JOIN g ON x.series_id = g.series_id
""", "TS4")
def acf_key(spark, sf):
    return TS.acf(events_daily(spark, sf), 20)


@register("adf_test", None, "TS3,UD3")
def adf_test(spark, sf):
    """Augmented Dickey-Fuller per daily series, from sums of products."""
    from adlake.timeseries.models import adf
    return adf(TS.first_difference(events_daily(spark, sf)).select("series_id", "day", "value"))


@register("arima_forecast", None, "TS5,TS6,UD3")
def arima_forecast(spark, sf):
    """ARIMA(3,1,2) per daily series: fitted values and a 25-step forecast."""
    from adlake.timeseries.models import arima
    return arima(TS.first_difference(events_daily(spark, sf)).select("series_id", "day", "value"), order=(3, 1, 2), steps=25)


@register("pacf", f"""
WITH RECURSIVE {SQL_DENSE_DAILY},
d AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY day) AS pos, count(*) OVER (PARTITION BY series_id) AS n,
             count(*) OVER (PARTITION BY series_id) * cents - SUM(cents) OVER (PARTITION BY series_id) AS d FROM series),
g AS (SELECT series_id, any_value(n) AS n, CAST(SUM(CAST(d AS HUGEINT) * d) AS DOUBLE) AS den FROM d GROUP BY 1),
c AS (SELECT a.series_id, a.pos - b.pos AS k, CAST(SUM(CAST(a.d AS HUGEINT) * b.d) AS DOUBLE) AS num
      FROM d a JOIN d b ON a.series_id = b.series_id AND b.pos < a.pos AND b.pos >= a.pos - 20 GROUP BY 1, 2),
rho AS (SELECT c.series_id, any_value(least(20, n - 2)) AS lags, list(CASE WHEN den > 0 THEN num / den * n / (n - k) END ORDER BY k) AS rho
        FROM c JOIN g ON c.series_id = g.series_id GROUP BY 1),
r AS (
  SELECT series_id, lags, rho, 1 AS lag, [rho[1]] AS phi FROM rho WHERE lags >= 1
  UNION ALL
  SELECT series_id, lags, rho, lag + 1,
         list_append(list_transform(range(1, lag + 1), lambda j: phi[j] - v * phi[lag + 1 - j]), v)
  FROM (SELECT *, (rho[lag + 1] - list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * rho[lag + 1 - j])))
                  / (1 - list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * rho[j]))) AS v FROM r WHERE lag < lags))
SELECT series_id, CAST(lag AS INTEGER) AS lag, CAST(round(CAST(phi[lag] AS DECIMAL(38,10)), 6) AS DOUBLE) AS pacf FROM r
""", "TS4")
def pacf_key(spark, sf):
    return TS.pacf(events_daily(spark, sf), 20)
