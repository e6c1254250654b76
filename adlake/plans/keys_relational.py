"""Registered keys for scans, projections, filters and joins (§2.1-2.4).

Every key reads whole driver tables.  Dates that the source takes from the
clock ("today", "last month") are an explicit ``as_of`` parameter here.
"""

from __future__ import annotations



from pyspark.sql import functions as F

from adlake.functions.core import (days_back, is_true, money_sum, previous_month_bounds,
                                   sum_null_propagating, sunday_week)
from adlake.operators import relational as R
from adlake.plans.driver_views import sql_week
from adlake.plans.registry import register
from adlake.sources.tables import Tables

# Run dates standing in for "today" (the driver data is historical).
ORDERS_AS_OF = "1998-08-15"
EVENTS_AS_OF = "2024-01-30"


def _t(spark, sf):
    return Tables(spark, sf)


# ------------------------------------------------------------------ scans

@register("report_extract", f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 50000 AND o_custkey > 5
  AND CAST(o_orderdate AS DATE) BETWEEN date_trunc('month', DATE '{ORDERS_AS_OF}') - INTERVAL 1 MONTH
                                    AND date_trunc('month', DATE '{ORDERS_AS_OF}') - INTERVAL 1 DAY
""", "SC5,FI1,FI8")
def report_extract(spark, sf):
    lo, hi = previous_month_bounds(ORDERS_AS_OF)
    o = _t(spark, sf).orders
    return (o.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 50000)
                    & (F.col("o_custkey") > 5) & F.to_date("o_orderdate").between(lo, hi))
            .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"))


@register("hourly_cost_extract", f"""
SELECT e.user_id AS campaign_id, CAST(e.ts AS DATE) AS day, hour(e.ts) AS hour_of_day, e.value AS cost
FROM events e
WHERE e.user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 90)
  AND e.event_type IN ('click', 'view') AND hour(e.ts) = 13
  AND CAST(e.ts AS DATE) BETWEEN DATE '{EVENTS_AS_OF}' - INTERVAL 28 DAY AND DATE '{EVENTS_AS_OF}'
""", "SC6,JO18,FI5")
def hourly_cost_extract(spark, sf):
    ev = _t(spark, sf).events
    ids = ev.where((F.col("event_type") == "purchase") & (F.col("value") > 90)).select("user_id")
    d = F.to_date("ts")
    return (R.semi_join(ev, ids, "user_id")
            .where(F.col("event_type").isin("click", "view") & (F.hour("ts") == 13)
                   & d.between(days_back(EVENTS_AS_OF, 28), F.to_date(F.lit(EVENTS_AS_OF))))
            .select(F.col("user_id").alias("campaign_id"), d.alias("day"),
                    F.hour("ts").alias("hour_of_day"), F.col("value").alias("cost")))


@register("multi_account_union", """
SELECT c.c_mktsegment AS account, o.o_orderkey, o.o_orderpriority, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment NOT IN ('AUTOMOBILE', 'MACHINERY')
""", "SC7,SE4")
def multi_account_union(spark, sf):
    t = _t(spark, sf)
    c = t.customer.where(~F.col("c_mktsegment").isin("AUTOMOBILE", "MACHINERY"))
    return (t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("c_mktsegment").alias("account"), "o_orderkey", "o_orderpriority",
                    "o_totalprice"))


@register("max_date_by_region", """
SELECT n.n_name AS country, max(CAST(o.o_orderdate AS DATE)) AS max_date,
       min(CAST(o.o_orderdate AS DATE)) AS min_date, count(*) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
""", "SC8,AG14")
def max_date_by_region(spark, sf):
    t = _t(spark, sf)
    # nation is a fixed 25-row dimension: safe to broadcast by construction
    j = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
         .join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey")))
    d = F.to_date("o_orderdate")
    return j.groupBy(F.col("n_name").alias("country")).agg(
        F.max(d).alias("max_date"), F.min(d).alias("min_date"), F.count("*").alias("n_orders"))


@register("lookback_filter", f"""
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 180 DAY
  AND CAST(o_orderdate AS DATE) <= DATE '{ORDERS_AS_OF}'
""", "SC9,SF11")
def lookback_filter(spark, sf):
    d = F.to_date("o_orderdate")
    return (_t(spark, sf).orders
            .where((d >= days_back(ORDERS_AS_OF, 180)) & (d <= F.to_date(F.lit(ORDERS_AS_OF))))
            .select("o_orderkey", "o_custkey", d.alias("order_date"), "o_totalprice"))


# ------------------------------------------------------------ projections

@register("project_alias", """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_retailprice AS list_price
FROM part
""", "PR1")
def project_alias(spark, sf):
    return _t(spark, sf).part.select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("list_price"))


@register("star_plus_computed", """
SELECT *, l_extendedprice * (1 - l_discount) AS net_price FROM lineitem
""", "PR4")
def star_plus_computed(spark, sf):
    li = _t(spark, sf).lineitem
    return li.select("*", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"))


@register("star_except", """
SELECT * EXCLUDE (o_totalprice, o_orderpriority) FROM orders
""", "PR5")
def star_except(spark, sf):
    return _t(spark, sf).orders.drop("o_totalprice", "o_orderpriority")


@register("margin_expressions", """
SELECT l_orderkey, l_linenumber,
  l_extendedprice * (1 - l_discount) AS net_sales,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross_with_tax,
  l_extendedprice * l_tax AS cost,
  -1 * (l_extendedprice * l_tax) AS neg_cost,
  l_extendedprice * (1 - l_discount) - l_extendedprice * l_tax AS margin,
  (l_extendedprice - l_extendedprice * l_discount) / NULLIF(l_quantity, 0) AS unit_net
FROM lineitem
""", "PR6,SF14")
def margin_expressions(spark, sf):
    li = _t(spark, sf).lineitem
    p, d, tx, q = (F.col(c) for c in ("l_extendedprice", "l_discount", "l_tax", "l_quantity"))
    return li.select(
        "l_orderkey", "l_linenumber",
        (p * (1 - d)).alias("net_sales"),
        (p * (1 - d) * (1 + tx)).alias("gross_with_tax"),
        (p * tx).alias("cost"),
        (F.lit(-1) * (p * tx)).alias("neg_cost"),
        (p * (1 - d) - p * tx).alias("margin"),
        F.try_divide(p - p * d, q).alias("unit_net"))


@register("audit_columns", """
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS report_date, 'SG' AS country,
       TIMESTAMP '2024-02-01 06:00:00' AS ingested_at
FROM orders
""", "PR12,SF10")
def audit_columns(spark, sf):
    return _t(spark, sf).orders.select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("report_date"),
        F.lit("SG").alias("country"),
        F.to_timestamp_ntz(F.lit("2024-02-01 06:00:00")).alias("ingested_at"))


@register("normalise_schema", """
SELECT o_custkey AS customer_id, '' AS blank_a, o_orderkey AS order_id, '' AS blank_b,
       o_orderstatus AS status, o_orderpriority AS priority
FROM orders
""", "PR7,PR8,PR9,PR10,PR11")
def normalise_schema(spark, sf):
    from adlake.operators.schema import normalise
    o = _t(spark, sf).orders.toDF(*[c.upper() for c in _t(spark, sf).orders.columns])
    return normalise(
        o, drop=["O_TOTALPRICE", "O_ORDERDATE"], lower=True, move={"o_custkey": 0},
        blanks={1: "blank_a", 3: "blank_b"},
        names=["customer_id", "blank_a", "order_id", "blank_b", "status", "priority"])


# ---------------------------------------------------------------- filters

@register("filter_eq_and", """
SELECT p_partkey, p_name, p_size FROM part WHERE p_type = 'SMALL' AND p_brand = 'Brand#3'
""", "FI1")
def filter_eq_and(spark, sf):
    return (_t(spark, sf).part.where((F.col("p_type") == "SMALL") & (F.col("p_brand") == "Brand#3"))
            .select("p_partkey", "p_name", "p_size"))


@register("filter_activity", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE (NULLIF(l_tax, 0) + l_discount + l_quantity) > 20
""", "FI2")
def filter_activity(spark, sf):
    li = _t(spark, sf).lineitem
    s = sum_null_propagating([F.nullif(F.col("l_tax"), F.lit(0.0)), "l_discount", "l_quantity"])
    return li.where(s > 20).select("l_orderkey", "l_linenumber", "l_partkey")


_LEFT_BUILDING_SQL = """
(SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderstatus, c.c_name, c.c_acctbal, c.c_mktsegment
 FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c
   ON o.o_custkey = c.c_custkey AND c.c_mktsegment = 'BUILDING')"""


def _left_building(spark, sf):
    """Orders left-joined to BUILDING customers with positive balance; the
    unmatched rows carry NULLs (the fixture for NULL handling keys)."""
    t = _t(spark, sf)
    c = t.customer.where((F.col("c_acctbal") > 0) & (F.col("c_mktsegment") == "BUILDING"))
    return (t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "c_name",
                    "c_acctbal", "c_mktsegment"))


@register("filter_not_null", f"""
SELECT o_orderkey, c_name FROM {_LEFT_BUILDING_SQL} j WHERE c_name IS NOT NULL
""", "FI3")
def filter_not_null(spark, sf):
    return _left_building(spark, sf).where(F.col("c_name").isNotNull()).select("o_orderkey", "c_name")


@register("dropna_subset", f"""
SELECT * FROM {_LEFT_BUILDING_SQL} j WHERE c_name IS NOT NULL AND c_acctbal IS NOT NULL
""", "FI4")
def dropna_subset(spark, sf):
    return _left_building(spark, sf).dropna(subset=["c_name", "c_acctbal"])


@register("filter_in_list", """
SELECT p_partkey, p_type FROM part WHERE lower(p_type) IN ('small', 'large', 'promo')
""", "FI5")
def filter_in_list(spark, sf):
    return (_t(spark, sf).part.where(F.lower("p_type").isin("small", "large", "promo"))
            .select("p_partkey", "p_type"))


@register("like_contains", """
SELECT p_partkey, p_name,
  contains(p_name, 'red') AS has_red,
  lower(p_name) LIKE '%' || lower('GEAR') || '%' AS has_gear_ci,
  p_name LIKE '%' || 'o_d' || '%' AS like_wildcard
FROM part WHERE contains(p_name, 'red') OR p_name ILIKE '%GEAR%' OR p_name LIKE '%o_d%'
""", "FI6,SF8")
def like_contains(spark, sf):
    from adlake.functions.core import contains_text
    p = _t(spark, sf).part
    red = contains_text("p_name", F.lit("red"))
    gear = contains_text("p_name", F.lit("GEAR"), mode="like", ignore_case=True)
    wild = contains_text("p_name", F.lit("o_d"), mode="like")
    return p.where(red | F.col("p_name").ilike("%GEAR%") | wild).select(
        "p_partkey", "p_name", red.alias("has_red"), gear.alias("has_gear_ci"),
        wild.alias("like_wildcard"))


@register("name_filter", """
SELECT DISTINCT p_partkey FROM part
WHERE NOT contains(lower(p_name), 'hot') AND NOT contains(lower(p_name), 'cold')
  AND (contains(lower(p_name), 'gear') OR contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt'))
  AND p_type IN ('STANDARD', 'PROMO')
""", "FI7")
def name_filter(spark, sf):
    from adlake.operators.filters import name_filter as nf
    p = _t(spark, sf).part
    return nf(p, "p_name", not_contains=["HOT", "cold"], contains=["gear", "Ring", "bolt"],
              status_col="p_type", statuses=["STANDARD", "PROMO"], id_col="p_partkey")


@register("date_relative", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
  CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' AS is_today_or_later,
  CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 1 DAY AS since_yesterday,
  CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 7 DAY AS last_7_days,
  CAST(o_orderdate AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 30 DAY AS last_30_days,
  CAST(o_orderdate AS DATE) BETWEEN date_trunc('month', DATE '{ORDERS_AS_OF}') - INTERVAL 1 MONTH
       AND date_trunc('month', DATE '{ORDERS_AS_OF}') - INTERVAL 1 DAY AS last_month
FROM orders
""", "FI8,SF11")
def date_relative(spark, sf):
    d = F.to_date("o_orderdate")
    lo, hi = previous_month_bounds(ORDERS_AS_OF)
    return (_t(spark, sf).orders.select(
        "o_orderkey", d.alias("d"),
        (d >= days_back(ORDERS_AS_OF, 0)).alias("is_today_or_later"),
        (d >= days_back(ORDERS_AS_OF, 1)).alias("since_yesterday"),
        (d >= days_back(ORDERS_AS_OF, 7)).alias("last_7_days"),
        (d >= days_back(ORDERS_AS_OF, 30)).alias("last_30_days"),
        d.between(lo, hi).alias("last_month")))


@register("filter_ne_nullsafe", f"""
SELECT o_orderkey, c_mktsegment FROM {_LEFT_BUILDING_SQL} j WHERE c_mktsegment IS DISTINCT FROM 'BUILDING'
""", "FI10")
def filter_ne_nullsafe(spark, sf):
    return (_left_building(spark, sf).where(~F.col("c_mktsegment").eqNullSafe("BUILDING"))
            .select("o_orderkey", "c_mktsegment"))


@register("boolean_three_valued", f"""
SELECT o_orderkey,
  COALESCE(c_acctbal > 5000, FALSE) AS rich_is_true,
  NOT (c_acctbal > 5000 OR o_orderstatus = 'F') AS neither,
  c_acctbal > 5000 AS rich_raw
FROM {_LEFT_BUILDING_SQL} j
""", "FI11")
def boolean_three_valued(spark, sf):
    j = _left_building(spark, sf)
    rich = F.col("c_acctbal") > 5000
    return j.select("o_orderkey", is_true(rich).alias("rich_is_true"),
                    (~(rich | (F.col("o_orderstatus") == "F"))).alias("neither"),
                    rich.alias("rich_raw"))


# ------------------------------------------------------------------ joins

@register("left_join_single", """
SELECT o.o_orderkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20) c ON o.o_custkey = c.c_custkey
""", "JO1")
def left_join_single(spark, sf):
    t = _t(spark, sf)
    c = t.customer.where(F.col("c_nationkey") < 20)
    return (t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment"))


@register("left_join_on_filter", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey AND lower(p.p_type) = 'small'
""", "JO2")
def left_join_on_filter(spark, sf):
    t = _t(spark, sf)
    p = t.part.select("p_partkey", "p_name", "p_type")
    return (R.left_join_on_filter(t.lineitem, p, F.col("l_partkey") == F.col("p_partkey"),
                                  F.lower("p_type") == "small")
            .select("l_orderkey", "l_linenumber", "l_partkey", "p_name"))


@register("left_join_composite", """
WITH m AS (
  SELECT o_custkey, year(o_orderdate) AS y, month(o_orderdate) AS m,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS month_total, count(*) AS month_orders
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3)
SELECT o.o_orderkey, o.o_custkey, m.month_total, m.month_orders
FROM orders o LEFT JOIN m ON o.o_custkey = m.o_custkey AND year(o.o_orderdate) = m.y
  AND month(o.o_orderdate) = m.m
""", "JO3")
def left_join_composite(spark, sf):
    o = _t(spark, sf).orders
    keyed = o.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"),
                     F.month("o_orderdate").alias("m"), "o_totalprice", "o_orderstatus")
    m = (keyed.where(F.col("o_orderstatus") == "F").groupBy("o_custkey", "y", "m")
         .agg(money_sum("o_totalprice").alias("month_total"), F.count("*").alias("month_orders")))
    return (keyed.join(m, ["o_custkey", "y", "m"], "left")
            .select("o_orderkey", "o_custkey", "month_total", "month_orders"))


@register("inner_join", """
SELECT o.o_orderkey, c.c_name, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
""", "JO4")
def inner_join(spark, sf):
    t = _t(spark, sf)
    return (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_name", "c_nationkey"))


_WEEK_BOUNDS_SQL = f"""
SELECT {sql_week('d')} AS week_number, year(d) AS year, min(d) AS week_start, max(d) AS week_end
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem) dd GROUP BY 1, 2"""


def _week_bounds(spark, sf):
    """AG3 over a date dimension derived from the shipped dates."""
    dates = _t(spark, sf).lineitem.select(F.to_date("l_shipdate").alias("d")).distinct()
    return (dates.groupBy(sunday_week("d").alias("week_number"), F.year("d").alias("year"))
            .agg(F.min("d").alias("week_start"), F.max("d").alias("week_end")))


@register("week_bounds", _WEEK_BOUNDS_SQL, "AG3,SF9")
def week_bounds(spark, sf):
    return _week_bounds(spark, sf)


@register("join_on_week", f"""
WITH wb AS ({_WEEK_BOUNDS_SQL})
SELECT o.o_orderkey, wb.week_start, wb.week_end
FROM orders o LEFT JOIN wb ON year(o.o_orderdate) = wb.year AND {sql_week('CAST(o.o_orderdate AS DATE)')} = wb.week_number
""", "JO5")
def join_on_week(spark, sf):
    o = _t(spark, sf).orders.select(
        "o_orderkey", F.year("o_orderdate").alias("year"),
        sunday_week(F.to_date("o_orderdate")).alias("week_number"))
    return (o.join(_week_bounds(spark, sf), ["year", "week_number"], "left")
            .select("o_orderkey", "week_start", "week_end"))


@register("left_then_filter", """
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'HOUSEHOLD'
""", "JO10")
def left_then_filter(spark, sf):
    t = _t(spark, sf)
    # written as the inner join it is (left join + null-rejecting WHERE)
    c = t.customer.where(F.col("c_mktsegment") == "HOUSEHOLD")
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@register("join_to_agg", """
WITH l AS (SELECT l_orderkey, count(*) AS n_lines,
                  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS line_total
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey, o.o_totalprice, l.n_lines, l.line_total
FROM orders o LEFT JOIN l ON o.o_orderkey = l.l_orderkey
""", "JO11,AG4")
def join_to_agg(spark, sf):
    t = _t(spark, sf)
    agg = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"),
                                                money_sum("l_extendedprice").alias("line_total"))
    return (t.orders.join(agg, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("o_orderkey", "o_totalprice", "n_lines", "line_total"))


@register("coalesce_fallback", """
SELECT o.o_orderkey, COALESCE(c.c_name, 'NATION:' || n.n_name) AS display_name
FROM orders o
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'FURNITURE') c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT c_custkey AS k, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey) n
  ON o.o_custkey = n.k
""", "JO12,SF1")
def coalesce_fallback(spark, sf):
    t = _t(spark, sf)
    primary = t.customer.where(F.col("c_mktsegment") != "FURNITURE").select(
        F.col("c_custkey").alias("o_custkey"), "c_name")
    fallback = (t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
                .select(F.col("c_custkey").alias("o_custkey"),
                        F.concat(F.lit("NATION:"), F.col("n_name")).alias("fb_name")))
    j = t.orders.select("o_orderkey", "o_custkey").join(primary, "o_custkey", "left")
    return (j.join(fallback, "o_custkey", "left")
            .select("o_orderkey", F.coalesce("c_name", "fb_name").alias("display_name")))


@register("config_lookup", """
WITH cfg AS (
  SELECT n_regionkey AS account, n_name AS contact, n_nationkey AS pos FROM nation
  QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC) = 1)
SELECT r.r_name AS account_name, cfg.contact, cfg.pos AS row_pos
FROM region r LEFT JOIN cfg ON r.r_regionkey = cfg.account
""", "JO14")
def config_lookup(spark, sf):
    t = _t(spark, sf)
    from adlake.operators.lookup import last_match_lookup
    cfg = t.nation.select(F.col("n_regionkey").alias("account"), F.col("n_name").alias("contact"),
                          F.col("n_nationkey").alias("pos"))
    last = last_match_lookup(cfg, "account", "pos", ["contact"])
    return (t.region.join(last, F.col("r_regionkey") == F.col("account"), "left")
            .select(F.col("r_name").alias("account_name"), "contact", F.col("pos").alias("row_pos")))


@register("dict_map", """
SELECT o_orderkey, o_orderpriority,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS priority_rank
FROM orders
""", "JO16")
def dict_map_key(spark, sf):
    m = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return _t(spark, sf).orders.select("o_orderkey", "o_orderpriority",
                                       R.dict_map("o_orderpriority", m).alias("priority_rank"))


@register("semi_join_ids", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)
""", "JO18")
def semi_join_ids(spark, sf):
    t = _t(spark, sf)
    ids = t.customer.where(F.col("c_acctbal") > 9000).select(F.col("c_custkey").alias("o_custkey"))
    return R.semi_join(t.orders, ids, "o_custkey").select("o_orderkey", "o_custkey")



