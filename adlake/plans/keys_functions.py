"""Registered keys for scalar functions and row features (§2.10, ML1-ML3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.functions import features as FE
from adlake.functions.core import greatest_strict, safe_divide, sunday_week, truncate_upper
from adlake.operators.relational import dict_map
from adlake.plans.driver_views import sql_week
from adlake.plans.keys_aggwin import round_half_up
from adlake.plans.keys_relational import _LEFT_BUILDING_SQL, _left_building
from adlake.plans.registry import register
from adlake.sources.tables import Tables


def _t(spark, sf):
    return Tables(spark, sf)


@register("fn_coalesce", f"""
SELECT o_orderkey, COALESCE(c_name, 'unknown') AS name, COALESCE(c_acctbal, 0) AS balance,
  COALESCE(c_mktsegment, '0') AS segment_filled, COALESCE(c_acctbal, 0) AS balance_filled
FROM {_LEFT_BUILDING_SQL} j
""", "SF1,S9")
def fn_coalesce(spark, sf):
    from adlake.operators.schema import fill_numeric_and_text
    return fill_numeric_and_text(_left_building(spark, sf).select(
        "o_orderkey", F.coalesce("c_name", F.lit("unknown")).alias("name"), F.coalesce("c_acctbal", F.lit(0.0)).alias("balance"),
        F.col("c_mktsegment").alias("segment_filled"), F.col("c_acctbal").alias("balance_filled")))


@register("fn_safe_divide", """
SELECT l_orderkey, l_linenumber, l_tax / NULLIF(l_discount, 0) AS tax_per_discount,
  l_extendedprice / l_quantity AS unit_price, 1.0 / 3 AS third
FROM lineitem
""", "SF2,S3")
def fn_safe_divide(spark, sf):
    li = _t(spark, sf).lineitem
    return li.select("l_orderkey", "l_linenumber", safe_divide("l_tax", "l_discount").alias("tax_per_discount"),
                     (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                     (F.lit(1.0) / F.lit(3)).alias("third"))


_PROP_TEXT_SQL = """CASE WHEN event_id % 7 = 0 THEN replace(substr(props, 7), '}', '') || '.5'
                         WHEN event_id % 11 = 0 THEN 'n/a' ELSE ' ' || replace(substr(props, 7), '}', ' ') END"""


def _prop_text(ev):
    """A text number derived from props ('{"k": 69}' -> ' 69 '), with a
    fractional and a non-numeric variant mixed in."""
    raw = F.expr("substring(props, 7)")
    return (F.when(F.col("event_id") % 7 == 0, F.concat(F.regexp_replace(raw, "}", ""), F.lit(".5")))
            .when(F.col("event_id") % 11 == 0, F.lit("n/a"))
            .otherwise(F.concat(F.lit(" "), F.regexp_replace(raw, "}", " "))))


@register("fn_try_cast", f"""
SELECT event_id, txt,
  CASE WHEN regexp_matches(trim(txt), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(txt) AS BIGINT) END AS rank
FROM (SELECT event_id, {_PROP_TEXT_SQL} AS txt FROM events) e
""", "SF3,SF21")
def fn_try_cast(spark, sf):
    ev = _t(spark, sf).events
    t = ev.select("event_id", _prop_text(ev).alias("txt"))
    return t.select("event_id", "txt", F.col("txt").try_cast("bigint").alias("rank"))


@register("fn_case", """
SELECT p_partkey,
  CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN CASE WHEN p_type = 'PROMO' THEN 'M-PROMO' ELSE 'M' END
       ELSE 'L' END AS size_band,
  CASE WHEN contains(p_name, 'gear') THEN 'Gear' WHEN contains(p_name, 'ring') THEN 'Ring' ELSE p_type END AS kind,
  CASE WHEN p_retailprice > 1500 THEN p_retailprice * 0.9 ELSE p_retailprice END AS price
FROM part
""", "SF4,SF23")
def fn_case(spark, sf):
    p = _t(spark, sf).part
    size = (F.when(F.col("p_size") < 10, "S")
            .when(F.col("p_size") < 30, F.when(F.col("p_type") == "PROMO", "M-PROMO").otherwise("M"))
            .otherwise("L"))
    kind = (F.when(F.col("p_name").contains("gear"), "Gear").when(F.col("p_name").contains("ring"), "Ring")
            .otherwise(F.col("p_type")))
    price = F.when(F.col("p_retailprice") > 1500, F.col("p_retailprice") * 0.9).otherwise(F.col("p_retailprice"))
    return p.select("p_partkey", size.alias("size_band"), kind.alias("kind"), price.alias("price"))


@register("fn_greatest_null", """
SELECT l_orderkey, l_linenumber,
  CASE WHEN NULLIF(l_tax, 0) IS NULL OR NULLIF(l_discount, 0) IS NULL THEN NULL
       ELSE greatest(NULLIF(l_tax, 0), NULLIF(l_discount, 0)) END AS g_strict,
  greatest(NULLIF(l_tax, 0), NULLIF(l_discount, 0)) AS g_skip
FROM lineitem
""", "SF5,S2")
def fn_greatest_null(spark, sf):
    li = _t(spark, sf).lineitem
    a, b = F.nullif(F.col("l_tax"), F.lit(0.0)), F.nullif(F.col("l_discount"), F.lit(0.0))
    return li.select("l_orderkey", "l_linenumber", greatest_strict(a, b).alias("g_strict"),
                     F.greatest(a, b).alias("g_skip"))


@register("fn_string_case_pad", """
SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, trim('  ' || p_name || '  ') AS trimmed,
  lpad(p_name, 15, '*') AS padded, lpad(p_name, 5, ' ') AS cut5,
  upper(trim(lpad(trim('  ' || p_name || ' ' || p_type || ' ' || p_brand || ' ' || p_name || ' ' || p_type), 30, ' '))) AS title30
FROM part
""", "SF6,S7")
def fn_string_case_pad(spark, sf):
    p = _t(spark, sf).part
    long = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(" "), F.col("p_brand"),
                    F.lit(" "), F.col("p_name"), F.lit(" "), F.col("p_type"))
    return p.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"),
                    F.trim(F.concat(F.lit("  "), F.col("p_name"), F.lit("  "))).alias("trimmed"),
                    F.lpad("p_name", 15, "*").alias("padded"), F.lpad("p_name", 5, " ").alias("cut5"),
                    truncate_upper(long, 30).alias("title30"))


@register("fn_concat_key", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || CAST(o_custkey AS VARCHAR)
  || NULLIF(o_orderstatus, 'P') AS k
FROM orders
""", "SF7,S10")
def fn_concat_key(spark, sf):
    o = _t(spark, sf).orders
    return o.select("o_orderkey", F.concat(F.to_date("o_orderdate").cast("string"), F.col("o_custkey").cast("string"),
                                           F.nullif(F.col("o_orderstatus"), F.lit("P"))).alias("k"))


@register("fn_extract_parts", f"""
SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m,
  {sql_week('CAST(o_orderdate AS DATE)')} AS week_sunday, weekofyear(o_orderdate) AS week_iso,
  dayofweek(o_orderdate) + 1 AS dow
FROM orders
""", "SF9,S1")
def fn_extract_parts(spark, sf):
    o = _t(spark, sf).orders
    d = F.to_date("o_orderdate")
    return o.select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), sunday_week(d).alias("week_sunday"),
                    F.weekofyear(d).alias("week_iso"), F.dayofweek(d).alias("dow"))


@register("fn_to_date", """
SELECT event_id, CAST(ts AS DATE) AS d, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_second,
  TRY_CAST(CASE WHEN event_id % 13 = 0 THEN 'not a date' ELSE strftime(ts, '%Y-%m-%d') END AS DATE) AS parsed
FROM events
""", "SF10")
def fn_to_date(spark, sf):
    ev = _t(spark, sf).events
    txt = F.when(F.col("event_id") % 13 == 0, F.lit("not a date")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return ev.select("event_id", F.to_date("ts").alias("d"),
                     F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_second"),
                     F.to_date(F.try_to_timestamp(txt, F.lit("yyyy-MM-dd"))).alias("parsed"))


@register("fn_date_format", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso_day, strftime(ts, '%Y%m%d') AS compact_day,
  dayname(ts) AS weekday, hour(timezone('America/New_York', ts AT TIME ZONE 'UTC')) AS account_hour
FROM events
""", "SF12")
def fn_date_format(spark, sf):
    ev = _t(spark, sf).events
    return ev.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("iso_day"),
                     F.date_format("ts", "yyyyMMdd").alias("compact_day"),
                     F.date_format("ts", "EEEE").alias("weekday"),
                     F.hour(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "America/New_York")).alias("account_hour"))


@register("fn_round", """
SELECT l_orderkey, l_linenumber,
  CAST(round(CAST(l_extendedprice * l_discount AS DECIMAL(38,10)), 2) AS DOUBLE) AS promo_2dp,
  abs(l_extendedprice * (l_tax - l_discount)) AS abs_delta,
  printf('%.2f', CAST(round(CAST(l_extendedprice * l_discount AS DECIMAL(38,10)), 2) AS DOUBLE)) AS promo_text
FROM lineitem
""", "SF13")
def fn_round(spark, sf):
    li = _t(spark, sf).lineitem
    r = round_half_up(F.col("l_extendedprice") * F.col("l_discount"), 2)
    return li.select("l_orderkey", "l_linenumber", r.alias("promo_2dp"),
                     F.abs(F.col("l_extendedprice") * (F.col("l_tax") - F.col("l_discount"))).alias("abs_delta"),
                     F.format_string("%.2f", r).alias("promo_text"))


@register("fn_split_nth", """
SELECT p_partkey, split_part(p_name, ' ', 2) AS second_word,
  split_part(p_brand || '/' || p_type, '/', 1) AS before_slash,
  CASE WHEN len(string_split(p_name, ' ')) >= 3 THEN string_split(p_name, ' ')[3] END AS third_word
FROM part
""", "SF15")
def fn_split_nth(spark, sf):
    p = _t(spark, sf).part
    return p.select("p_partkey", FE.split_nth("p_name", " ", 1).alias("second_word"),
                    FE.split_nth(F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")), "/", 0).alias("before_slash"),
                    FE.split_nth("p_name", " ", 2).alias("third_word"))


@register("fn_regex_replace", """
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '', 'g') AS no_vowels,
  regexp_replace(p_brand, 'Brand#', '') AS brand_no
FROM part
""", "SF16")
def fn_regex_replace(spark, sf):
    p = _t(spark, sf).part
    return p.select("p_partkey", F.regexp_replace("p_name", "[aeiou]", "").alias("no_vowels"),
                    F.regexp_replace("p_brand", "Brand#", "").alias("brand_no"))


@register("fn_contains_flag", """
SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'IsRing' ELSE 'simple' END AS ring_flag,
  split_part(replace(p_name || '/' || p_type, 'ring', ''), '/', 1) AS simple_name
FROM part
""", "SF17")
def fn_contains_flag(spark, sf):
    p = _t(spark, sf).part
    return p.select("p_partkey", FE.mix_flag("p_name", "ring", "IsRing", "simple").alias("ring_flag"),
                    FE.simple_breed(F.concat(F.col("p_name"), F.lit("/"), F.col("p_type")), "ring").alias("simple_name"))


_AGE_TEXT_SQL = """CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey % 20 AS VARCHAR) || ' ' ||
  CASE o_orderpriority WHEN '1-URGENT' THEN 'year' WHEN '2-HIGH' THEN 'years' WHEN '3-MEDIUM' THEN 'months'
       WHEN '4-NOT SPECIFIED' THEN 'weeks' ELSE 'days' END END"""


def _age_text(o):
    unit = dict_map("o_orderpriority", {"1-URGENT": "year", "2-HIGH": "years", "3-MEDIUM": "months",
                                        "4-NOT SPECIFIED": "weeks"}, default="days")
    return F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string")).otherwise(
        F.concat((F.col("o_custkey") % 20).cast("string"), F.lit(" "), unit))


@register("duration_to_days", f"""
SELECT o_orderkey, age_text,
  COALESCE(TRY_CAST(split_part(age_text, ' ', 1) AS DOUBLE), 0) *
    CASE split_part(age_text, ' ', 2) WHEN 'year' THEN 365.0 WHEN 'years' THEN 365.0 WHEN 'week' THEN 7.0
      WHEN 'weeks' THEN 7.0 WHEN 'month' THEN 30.5 WHEN 'months' THEN 30.5 WHEN 'days' THEN 1.0
      WHEN 'day' THEN 1.0 END AS age_days
FROM (SELECT o_orderkey, {_AGE_TEXT_SQL} AS age_text FROM orders) o
""", "SF18,SF19")
def duration_to_days(spark, sf):
    o = _t(spark, sf).orders
    a = o.select("o_orderkey", _age_text(o).alias("age_text"))
    return a.select("o_orderkey", "age_text", FE.duration_days("age_text").alias("age_days"))


@register("bucket_features", """
SELECT event_id,
  CASE WHEN hour(ts) > 5 AND hour(ts) < 12 THEN 'morning' WHEN hour(ts) > 11 AND hour(ts) < 16 THEN 'afternoon'
       WHEN hour(ts) > 15 AND hour(ts) < 20 THEN 'evening' ELSE 'night' END AS time_of_day,
  CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 'weekend' ELSE 'weekday' END AS weekday_flag,
  CASE WHEN value / 10 <= 1.5 THEN 'baby' WHEN value / 10 <= 7 THEN 'adult'
       WHEN value IS NOT NULL THEN 'senior' END AS life_stage,
  CASE WHEN CAST(trunc(value) AS INTEGER) < 1 THEN 'less than a day'
       WHEN CAST(trunc(value) AS INTEGER) < 7 THEN 'for a day or week'
       WHEN CAST(trunc(value) AS INTEGER) < 30.5 THEN 'more than a week'
       WHEN value IS NOT NULL THEN 'more than month' END AS stay_band
FROM events
""", "SF20,ML2")
def bucket_features(spark, sf):
    ev = _t(spark, sf).events
    return ev.select("event_id", FE.time_of_day(F.hour("ts")).alias("time_of_day"),
                     FE.weekend_flag(F.date_format("ts", "EEEE")).alias("weekday_flag"),
                     FE.life_stage(F.col("value") / 10).alias("life_stage"),
                     FE.stay_band("value").alias("stay_band"))


@register("fn_json_field", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
""", "SF24")
def fn_json_field(spark, sf):
    ev = _t(spark, sf).events
    k = F.get_json_object("props", "$.k")
    return ev.select("event_id", k.alias("k_text"), k.cast("bigint").alias("k"))


@register("category_codes", """
WITH cats AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
              FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL))
SELECT o_orderkey, COALESCE(cats.code, -1) AS priority_code
FROM orders LEFT JOIN cats ON orders.o_orderpriority = cats.v
""", "SF25")
def category_codes(spark, sf):
    from adlake.ml.features import category_codes as cc
    o = _t(spark, sf).orders
    return cc(o, "o_orderpriority", "priority_code").select("o_orderkey", "priority_code")


@register("one_hot", """
SELECT o_orderkey,
  CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F,
  CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O,
  CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P
FROM orders
""", "ML3")
def one_hot(spark, sf):
    from adlake.ml.features import dummies
    o = _t(spark, sf).orders
    return dummies(o, "o_orderstatus", ["F", "O", "P"]).select(
        "o_orderkey", "o_orderstatus_F", "o_orderstatus_O", "o_orderstatus_P")


@register("impute_mode", """
WITH j AS (SELECT o.o_orderkey, c.c_mktsegment FROM orders o
           LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey),
m AS (SELECT c_mktsegment AS v FROM j WHERE c_mktsegment IS NOT NULL GROUP BY 1
      ORDER BY count(*) DESC, c_mktsegment DESC LIMIT 1)
SELECT o_orderkey, COALESCE(c_mktsegment, (SELECT v FROM m)) AS segment FROM j
""", "ML1,SF1")
def impute_mode(spark, sf):
    from adlake.ml.features import impute_with_mode
    t = _t(spark, sf)
    c = t.customer.where(F.col("c_acctbal") > 0)
    j = t.orders.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_mktsegment")
    return impute_with_mode(j, "c_mktsegment").select("o_orderkey", F.col("c_mktsegment").alias("segment"))
