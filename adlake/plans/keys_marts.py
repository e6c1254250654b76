"""Registered keys for the composite marts MA2-MA10 and their parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.plans import driver_views as dv
from adlake.plans.registry import register
from adlake.sources.tables import Tables


def _t(spark, sf):
    return Tables(spark, sf)


# One row per (campaign, day) with a list of three slots; shares are taken on
# slot rows; a table says what holds where the slots sold nothing.
SALES_DIVISORS_SQL = f"""
WITH {dv.SQL_MA2_INPUTS},
from_api AS (
  SELECT report_date, campaign_id, 2 AS priority,
         (list([creative_asin1, creative_asin2, creative_asin3]
               ORDER BY creative_asin1 NULLS FIRST, creative_asin2 NULLS FIRST, creative_asin3 NULLS FIRST))[1] AS slots
  FROM api_rows GROUP BY ALL),
from_name AS (
  SELECT report_date, campaign_id, CASE WHEN count(child_asin) = 0 THEN 3 ELSE 1 END AS priority,
         coalesce(list(DISTINCT child_asin ORDER BY child_asin) FILTER (WHERE child_asin IS NOT NULL), []) AS slots
  FROM (SELECT report_date, campaign_id, min(campaign_name) AS campaign_name FROM ad_groups GROUP BY ALL)
  LEFT JOIN (SELECT DISTINCT child_asin FROM product_master) ON contains(campaign_name, child_asin) GROUP BY ALL),
chosen AS (
  SELECT report_date, campaign_id, arg_min(slots, priority) AS slots
  FROM (FROM from_api UNION ALL BY NAME FROM from_name) GROUP BY ALL),
fallback AS (
  SELECT campaign_id, [min(creative_asins1), min(creative_asins2), min(creative_asins3)] AS slots FROM bulk GROUP BY ALL),
sold AS (
  SELECT asin, purchased_date_utc AS report_date, CAST(sum(CAST(coalesce(item_price_usd, 0) AS DECIMAL(18,2))) AS DOUBLE) AS amount
  FROM pnl GROUP BY ALL),
slot AS (
  SELECT report_date, campaign_id, k, coalesce(chosen.slots[k], fallback.slots[k]) AS asin
  FROM chosen LEFT JOIN fallback USING (campaign_id) CROSS JOIN range(1, 4) AS s(k)),
whole AS (
  SELECT report_date, campaign_id, list(asin ORDER BY k) AS a, list(coalesce(amount, 0) ORDER BY k) AS x
  FROM slot LEFT JOIN sold USING (asin, report_date) GROUP BY ALL),
unsold(second, third, shares) AS (
  VALUES (true, true, [1/3, 1/3, 1/3]), (true, false, [0.5, 0.5, 0.0]), (false, false, [1.0, 0.0, 0.0]), (false, true, [0.0, 0.0, 0.0]))
SELECT report_date, campaign_id, a[1] AS creative_asin1, a[2] AS creative_asin2, a[3] AS creative_asin3,
       CAST(d[1] AS DOUBLE) AS divisor_1, CAST(d[2] AS DOUBLE) AS divisor_2, CAST(d[3] AS DOUBLE) AS divisor_3
FROM (SELECT report_date, campaign_id, a,
             CASE WHEN x[1] + x[2] + x[3] = 0 THEN shares ELSE list_transform(x, lambda v: v / (x[1] + x[2] + x[3])) END AS d
      FROM whole JOIN unsold ON second = (a[2] IS NOT NULL) AND third = (a[3] IS NOT NULL) WHERE a[1] IS NOT NULL)
"""


@register("sales_divisors", SALES_DIVISORS_SQL, "MA2,RS2,RS3,RS4,JO6,JO7,JO8,JO9,JO12,SE2,SE3,WI3,WI4,AG4,AG5,PR14,S12")
def sales_divisors(spark, sf):
    from adlake.plans.divisors import sales_divisors as sd
    t = _t(spark, sf)
    o, li = t.orders, t.lineitem
    return sd(dv.campaigns_api(o, li), dv.ad_groups(o, li), dv.product_master(t.part), dv.pnl(li),
              dv.bulk_ops(o, li))


@register("contains_join", """
WITH names AS (SELECT DISTINCT p_name AS w FROM part),
words AS (SELECT DISTINCT unnest(string_split(w, ' ')) AS word FROM names)
SELECT c.conv_id, c.turn, w.word
FROM conversations c LEFT JOIN words w ON contains(c.text, w.word)
""", "JO6")
def contains_join_key(spark, sf):
    """Which product-name words each conversation turn mentions (whole
    texts; literal substring semantics)."""
    from adlake.operators.textjoin import contains_join
    t = _t(spark, sf)
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    conv = t.conversations.select("conv_id", "turn", "text")
    return contains_join(conv, "text", words, "word").select("conv_id", "turn", "word")


@register("contains_documents", """
WITH words AS (
  SELECT DISTINCT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark))
SELECT d.doc_id, w.word FROM documents d JOIN words w ON contains(d.text, w.word)
""", "JO6")
def contains_documents(spark, sf):
    """Which benchmark words each whole document mentions."""
    from adlake.operators.textjoin import contains_matches
    t = _t(spark, sf)
    words = t.benchmark.select(F.explode(F.split("text", " ")).alias("word"))
    return contains_matches(t.documents, ["doc_id"], "text", words, "word")


@register("unnest_nested", f"""
WITH {dv.SQL_MA2_INPUTS}
SELECT CAST(o.o_orderdate AS DATE) AS report_date, o.o_custkey AS campaign_id, a.asin
FROM orders o JOIN order_asins oa ON o.o_orderkey = oa.l_orderkey, unnest(oa.asins) AS a(asin)
WHERE o.o_orderstatus = 'F'
""", "JO9,RS2")
def unnest_nested(spark, sf):
    t = _t(spark, sf)
    api = dv.campaigns_api(t.orders, t.lineitem)
    p = api.select(F.to_date("params.report_date").alias("report_date"), F.explode("payload").alias("p"))
    c = p.select("report_date", F.explode("p.campaigns").alias("c"))
    return c.select("report_date", F.col("c.campaignid").alias("campaign_id"),
                    F.explode("c.creative.asins").alias("asin"))


@register("array_safe_ordinal", f"""
WITH {dv.SQL_MA2_INPUTS}
SELECT l_orderkey, asins[1] AS a1, asins[3] AS a3, asins[9] AS a9 FROM order_asins
""", "RS3")
def array_safe_ordinal(spark, sf):
    from adlake.operators.reshape import safe_ordinal
    oa = dv.order_asins(_t(spark, sf).lineitem)
    return oa.select("l_orderkey", safe_ordinal(F.col("asins"), 1).alias("a1"),
                     safe_ordinal(F.col("asins"), 3).alias("a3"), safe_ordinal(F.col("asins"), 9).alias("a9"))


WEEKLY_RANK_MARKET = "AMERICA"

WEEKLY_RANK_SQL = f"""
WITH {dv.SQL_MA3_INPUTS},
reading AS (
  SELECT year(timestamp_ingested) AS year, {dv.sql_week('CAST(timestamp_ingested AS DATE)')} AS week, asin, phrase,
         arg_max(trim(rank), struct_pack(t := timestamp_ingested, r := rank)) AS rank
  FROM rank_raw SEMI JOIN (FROM niche_master WHERE marketplace_id = '{WEEKLY_RANK_MARKET}') USING (niche_id) GROUP BY ALL),
weeks AS (SELECT year, week_number AS week, min(full_date) AS wc_date, max(full_date) AS we_date FROM date_dimension GROUP BY ALL)
SELECT concat(wc_date, asin, phrase) AS unique_key, year, week, wc_date, we_date, asin, phrase,
       CASE WHEN regexp_full_match(rank, '[+-]?[0-9]+') THEN TRY_CAST(rank AS BIGINT) END AS h10_rank
FROM reading LEFT JOIN weeks USING (year, week)
"""


@register("weekly_rank", WEEKLY_RANK_SQL, "MA3,AG3,JO4,JO5,WI2,SF3,SF7,S1")
def weekly_rank(spark, sf):
    from adlake.plans.weekly_rank import weekly_rank as wr
    t = _t(spark, sf)
    ev = t.events
    return wr(dv.rank_raw(ev), dv.niche_master(t.nation, t.region), dv.date_dimension(ev), WEEKLY_RANK_MARKET)


# All totals come from one relation by grouping sets.
_ADS_TOTAL = "CAST(sum(CAST({} AS DECIMAL(22,4))) AS DOUBLE)"
_ADS_DAILY = (("Ordered_Product_Sales", "ordered_product_sales_adjusted"), ("sessions_total", "sessions_adjusted"),
              ("Units_Ordered", "units_ordered_adjusted"), ("Total_Order_Items", "total_order_items_adjusted"),
              ("Units_Refunded", "units_refunded_adjusted"), ("Feedback_Received", "feedback_received_adjusted"))
_ADS_PRODUCT = (("sessions_total", "monthly_sessions"), ("page_views_total", "monthly_pageviews"), ("units_ordered", "monthly_units_ordered"),
                ("ordered_product_sales", "monthly_ordered_product_sales"), ("total_order_items", "monthly_total_units_ordered"))

ADS_SUMMARY_SQL = f"""
WITH {dv.SQL_MA4_INPUTS},
fact AS (SELECT *, date_trunc('month', Date) AS m FROM search_terms),
totals AS (
  SELECT Customer_Search_Term, Targeting, Date, m, grouping(Customer_Search_Term, Targeting, Date) AS kind, count(*) AS n,
         {_ADS_TOTAL.format("spend")} AS spend, CAST(sum(Clicks) AS BIGINT) AS clicks, {_ADS_TOTAL.format("_14_Day_Total_Sales")} AS sales
  FROM fact GROUP BY GROUPING SETS ((Customer_Search_Term, m), (Targeting, m), (Date))),
renamed AS (
  SELECT f.* EXCLUDE (campaign_name, ad_group_name), coalesce(campaign_new, campaign_name) AS campaign_name,
         coalesce(ad_group_new, ad_group_name) AS ad_group_name, product_type
  FROM fact f LEFT JOIN (SELECT DISTINCT campaign, campaign_new FROM campaign_map) ON campaign = campaign_name
  LEFT JOIN (SELECT DISTINCT ad_group, ad_group_new, product_type FROM campaign_map) ON ad_group = ad_group_name),
product AS (
  SELECT product_type, date_trunc('month', Date) AS m, {", ".join(f"{_ADS_TOTAL.format(c)} AS p_{c}" for c, _ in _ADS_PRODUCT)}
  FROM asin_traffic GROUP BY ALL),
per_type AS (SELECT product_type, m, count(*) AS n FROM renamed GROUP BY ALL)
SELECT r.* EXCLUDE (m), term.spend AS st_monthly_spend, term.clicks AS st_monthly_clicks, term.sales AS st_monthly_sales,
       tgt.spend AS kw_monthly_spend, tgt.clicks AS kw_monthly_clicks, tgt.sales AS kw_monthly_sales,
       {", ".join(f"day.{c}, day.{c} / per_day.n AS {a}" for c, a in _ADS_DAILY)},
       {", ".join(f"CAST(round(CAST(p_{c} / per_type.n AS DECIMAL(38,10)), 2) AS DOUBLE) AS {a}" for c, a in _ADS_PRODUCT)}
FROM renamed r
LEFT JOIN totals term ON term.kind = 3 AND term.Customer_Search_Term = r.Customer_Search_Term AND term.m = r.m
LEFT JOIN totals tgt ON tgt.kind = 5 AND tgt.Targeting = r.Targeting AND tgt.m = r.m
LEFT JOIN totals per_day ON per_day.kind = 6 AND per_day.Date = r.Date
LEFT JOIN sales_traffic day ON day.Date = r.Date
LEFT JOIN product ON product.product_type = r.product_type AND product.m = r.m
LEFT JOIN per_type ON per_type.product_type = r.product_type AND per_type.m = r.m
"""


@register("ads_summary", ADS_SUMMARY_SQL, "MA4,AG1,AG2,AG16,AG17,JO1,JO3,JO17,PR5,SF13")
def ads_summary(spark, sf):
    from adlake.plans.ads_summary import ads_summary as ads
    t = _t(spark, sf)
    li = t.lineitem
    return ads(dv.search_terms(li), dv.sales_traffic(t.orders), dv.campaign_map(t.part), dv.asin_traffic(li))


# ----------------------------------------------------------------- MA6
SNAPSHOT_RUN = "2024-01-30"

_SNAP_SQL = """
snap AS (
  SELECT strftime(ts, '%Y-%m-%d') AS run_id, user_id AS tour_id,
    CASE WHEN bool_or(event_type = 'error' AND value >= 99) THEN 'returned_error'
         ELSE CAST(SUM(CAST(round(value * 100) AS BIGINT)) // 100 AS VARCHAR) END AS slots
  FROM events GROUP BY 1, 2)"""


def _snapshots(spark, sf):
    """Slot snapshot per run (day) and tour (user): whole units of value, or
    'returned_error' when the fetch failed (an error event of value >= 99)."""
    ev = _t(spark, sf).events
    g = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.col("user_id").alias("tour_id")).agg(
        F.max((F.col("event_type") == "error") & (F.col("value") >= 99)).alias("_err"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("_c"), F.min("event_id").alias("row_no"))
    return g.select("run_id", "tour_id", "row_no", F.when(F.col("_err"), F.lit("returned_error"))
                    .otherwise(F.expr("_c div 100").cast("string")).alias("slots"))


_CHANGE_SQL = f"""
WITH {_SNAP_SQL},
cur AS (SELECT tour_id, slots AS current_slots FROM snap WHERE run_id = '{SNAPSHOT_RUN}'),
prev AS (SELECT tour_id, slots AS previous_slots, run_id AS previous_run_id FROM snap
         WHERE run_id = (SELECT max(run_id) FROM snap WHERE run_id < '{SNAPSHOT_RUN}')),
pair AS (SELECT cur.tour_id, current_slots, previous_slots, previous_run_id FROM cur LEFT JOIN prev ON cur.tour_id = prev.tour_id),
ch AS (
  SELECT tour_id,
    CASE WHEN regexp_matches(trim(current_slots), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(current_slots) AS BIGINT) END AS current,
    CASE WHEN regexp_matches(trim(previous_slots), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(previous_slots) AS BIGINT) END AS previous
  FROM pair),
k AS (SELECT tour_id, current, previous, current - previous AS change FROM ch),
flagged AS (
  SELECT *, CASE WHEN (current BETWEEN 0 AND 10 AND change < -6) OR (current BETWEEN 11 AND 50 AND change < -8)
    OR (current BETWEEN 51 AND 150 AND change < -10) OR (current BETWEEN 151 AND 400 AND change < -15)
    OR (current BETWEEN 401 AND 1000 AND change < -20) OR (current >= 1001 AND change < -40)
    THEN 'Yes' ELSE 'No' END AS drop_flag FROM k)"""


@register("snapshot_previous", f"""
WITH {_SNAP_SQL},
cur AS (SELECT tour_id, slots AS current_slots FROM snap WHERE run_id = '{SNAPSHOT_RUN}'),
prev AS (SELECT tour_id, slots AS previous_slots, run_id AS previous_run_id FROM snap
         WHERE run_id = (SELECT max(run_id) FROM snap WHERE run_id < '{SNAPSHOT_RUN}'))
SELECT cur.tour_id, current_slots, previous_slots, previous_run_id FROM cur LEFT JOIN prev ON cur.tour_id = prev.tour_id
""", "SK9,JO13")
def snapshot_previous(spark, sf):
    from adlake.plans.operations import snapshot_pair
    return snapshot_pair(_snapshots(spark, sf), SNAPSHOT_RUN)


@register("inventory_change", _CHANGE_SQL + "\nSELECT * FROM flagged", "MA6,JO13,WI9,FI13,SF3")
def inventory_change(spark, sf):
    from adlake.plans.operations import inventory_change as ic
    return ic(_snapshots(spark, sf), SNAPSHOT_RUN)


@register("topk_increase", _CHANGE_SQL + "\nSELECT * FROM flagged WHERE change > 1 ORDER BY change DESC, tour_id LIMIT 12",
          "SO2")
def topk_increase(spark, sf):
    from adlake.plans.operations import inventory_change as ic, top_increases
    return top_increases(ic(_snapshots(spark, sf), SNAPSHOT_RUN), 12)


@register("ordered_drops", _CHANGE_SQL + "\nSELECT * FROM flagged WHERE drop_flag = 'Yes' AND change IS NOT NULL",
          "SO3")
def ordered_drops(spark, sf):
    from adlake.plans.operations import inventory_change as ic, flagged_drops
    return flagged_drops(ic(_snapshots(spark, sf), SNAPSHOT_RUN))


@register("banded_rule", f"""
WITH {_SNAP_SQL},
n AS (SELECT run_id, tour_id,
        CASE WHEN regexp_matches(trim(slots), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(slots) AS BIGINT) END AS current,
        lag(CASE WHEN regexp_matches(trim(slots), '^[+-]?[0-9]+$') THEN TRY_CAST(trim(slots) AS BIGINT) END)
          OVER (PARTITION BY tour_id ORDER BY run_id) AS previous FROM snap)
SELECT run_id, tour_id, current, current - previous AS change,
  CASE WHEN (current BETWEEN 0 AND 10 AND current - previous < -6) OR (current BETWEEN 11 AND 50 AND current - previous < -8)
    OR (current BETWEEN 51 AND 150 AND current - previous < -10) OR (current BETWEEN 151 AND 400 AND current - previous < -15)
    OR (current BETWEEN 401 AND 1000 AND current - previous < -20) OR (current >= 1001 AND current - previous < -40)
    THEN 'Yes' ELSE 'No' END AS drop_flag
FROM n
""", "FI13,WI9")
def banded_rule(spark, sf):
    from pyspark.sql import Window
    from adlake.operators.filters import banded_flag
    from adlake.plans.operations import DROP_BANDS
    s = _snapshots(spark, sf)
    cur = F.col("slots").try_cast("bigint")
    prev = F.lag(cur).over(Window.partitionBy("tour_id").orderBy("run_id"))
    x = s.select("run_id", "tour_id", cur.alias("current"), prev.alias("previous"))
    ch = F.col("current") - F.col("previous")
    return x.select("run_id", "tour_id", "current", ch.alias("change"),
                    banded_flag(F.col("current"), ch, DROP_BANDS).alias("drop_flag"))


# ----------------------------------------------------------------- MA7
ALERT_AS_OF, ALERT_HOUR = "2024-01-29", 13
ALERT_NOT, ALERT_ANY = ("-13",), ("CAMPAIGN-1", "campaign-2", "campaign-7")

SPEND_ALERT_SQL = f"""
WITH cost AS (
  SELECT 'account-' || CAST(user_id % 5 AS VARCHAR) AS account, user_id AS campaign_id, 'Campaign-' || CAST(user_id AS VARCHAR) AS name,
         CASE event_type WHEN 'error' THEN 'PAUSED' ELSE 'ENABLED' END AS status, CAST(ts AS DATE) AS d, hour(ts) AS h, value AS cost,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS amount FROM events),
config AS (
  SELECT 'account-' || CAST(n_nationkey % 5 AS VARCHAR) AS account, CASE n_nationkey % 5 WHEN 3 THEN 'n/a' ELSE CAST(30 + n_nationkey AS VARCHAR) END AS pct,
         CAST(1 + n_nationkey % 5 AS VARCHAR) AS min_abs, lower(n_name) AS contact, n_nationkey AS pos FROM nation),
limits AS (
  SELECT account, TRY_CAST(arg_max(pct, pos) AS DOUBLE) AS pct, TRY_CAST(arg_max(min_abs, pos) AS DOUBLE) AS min_abs, arg_max(contact, pos) AS contact
  FROM config GROUP BY 1 HAVING TRY_CAST(arg_max(pct, pos) AS DOUBLE) > 0 AND TRY_CAST(arg_max(min_abs, pos) AS DOUBLE) > 0),
active AS (
  SELECT DISTINCT campaign_id FROM cost
  WHERE d BETWEEN DATE '{ALERT_AS_OF}' - INTERVAL 30 DAY AND DATE '{ALERT_AS_OF}' - INTERVAL 1 DAY AND status = 'ENABLED'
    AND NOT contains(name, '-13') AND regexp_matches(name, '^Campaign-[127]')),
spend AS (
  SELECT account, campaign_id, max(name) AS name, d, CAST(sum(CAST(cost AS DECIMAL(18,2))) AS DOUBLE) AS cost,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount
  FROM cost SEMI JOIN active USING (campaign_id) WHERE status = 'ENABLED' AND h = {ALERT_HOUR} GROUP BY ALL),
pair AS (
  SELECT account, campaign_id, max(name) AS name, coalesce(sum(cost) FILTER (WHERE d = DATE '{ALERT_AS_OF}'), 0) AS today,
         coalesce(sum(amount) FILTER (WHERE d = DATE '{ALERT_AS_OF}'), 0) AS budget,
         CAST(coalesce(sum(CAST(cost AS DECIMAL(18,2))) FILTER (WHERE d IN (SELECT DATE '{ALERT_AS_OF}' - to_days(7 * CAST(k AS INTEGER)) FROM range(1, 5) r(k))), 0)
              AS DOUBLE) / 4 AS average
  FROM spend WHERE d BETWEEN DATE '{ALERT_AS_OF}' - INTERVAL 28 DAY AND DATE '{ALERT_AS_OF}' GROUP BY ALL)
SELECT account, contact, campaign_id, name, {ALERT_HOUR} AS hour, today, budget, average, today - average AS difference,
       CASE WHEN average = 0 THEN CAST('inf' AS DOUBLE) ELSE (today - average) / average * 100.0 END AS pct_change, pct
FROM pair JOIN limits USING (account)
WHERE today - average >= min_abs AND (average = 0 OR abs((today - average) / average * 100.0) > pct)"""


def alert_inputs(spark, sf, *more):
    """Cost rows, with `more` columns of events, and the config sheet of the
    alert keys."""
    t = _t(spark, sf)
    cost = t.events.select(
        F.concat(F.lit("account-"), (F.col("user_id") % 5).cast("string")).alias("account"), F.col("user_id").alias("campaign_id"),
        F.concat(F.lit("Campaign-"), F.col("user_id").cast("string")).alias("name"),
        F.when(F.col("event_type") == "error", "PAUSED").otherwise("ENABLED").alias("status"), "ts", F.col("value").alias("cost"),
        F.get_json_object("props", "$.k").cast("double").alias("amount"), *more)
    key = F.col("n_nationkey")
    config = t.nation.select(
        F.concat(F.lit("account-"), (key % 5).cast("string")).alias("account"),
        F.when(key % 5 == 3, "n/a").otherwise((key + 30).cast("string")).alias("pct"), (key % 5 + 1).cast("string").alias("abs"),
        F.lower("n_name").alias("contact"), key.alias("pos"))
    return cost, config


def _alerts(spark, sf):
    from adlake.plans.operations import AlertParams, spend_alert as sa
    cost, config = alert_inputs(spark, sf)
    return sa(cost, config, AlertParams(ALERT_AS_OF, ALERT_HOUR, not_contains=ALERT_NOT, contains=ALERT_ANY))


@register("spend_alert", SPEND_ALERT_SQL, "MA7,SC6,AG9,FI7,FI14,JO14,JO18,S13")
def spend_alert(spark, sf):
    return _alerts(spark, sf)


_TWO = "CASE WHEN isinf({0}) THEN 'Infinity' ELSE printf('%.2f', CAST(round(CAST({0} AS DECIMAL(38,10)), 2) AS DOUBLE)) END"


@register("alert_messages", f"""
WITH a AS ({SPEND_ALERT_SQL}),
n AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY campaign_id) AS no FROM a)
SELECT account, CAST(0 AS BIGINT) AS part, account || ' Campaigns exceeded threshold.' AS subject,
  '@' || max(contact) || chr(10) || 'The following campaigns have exceeded the ' || {_TWO.format("max(pct)")} || '% spend threshold:' || chr(10) || chr(10) ||
  string_agg(no || '. ' || chr(10) || 'Name: ' || name || chr(10) || 'Change(%): ' || {_TWO.format("pct_change")} || chr(10) ||
             'Change(abs): ' || {_TWO.format("difference")} || chr(10) || 'Hour: ' || hour || chr(10) || 'Daily Budget ($): ' || {_TWO.format("budget")} || chr(10) ||
             'Spend ($): ' || {_TWO.format("today")} || chr(10) || chr(10), '' ORDER BY no) AS body
FROM n GROUP BY account
""", "SK10,SF13")
def alert_messages(spark, sf):
    from adlake.plans.operations import alert_messages as am
    return am(_alerts(spark, sf))


# ----------------------------------------------------------------- MA9
@register("estimate_mean", """
WITH req AS (
  SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS text, min(event_id) AS request_id FROM events
  GROUP BY 1 HAVING NOT bool_or(event_type = 'error' OR event_id % 50 = 0)),
resp AS (
  SELECT event_id AS request_id, value / 3 AS clicks_min,
         CASE WHEN event_id % 9 <> 0 THEN value / 3 + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 7 END AS clicks_max,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 1000 AS impr_min, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 1000 + 0.006 AS impr_max
  FROM events)
SELECT request_id, text,
  CAST(round_even((CAST(clicks_min AS DECIMAL(28,10)) + CAST(clicks_max AS DECIMAL(28,10))) * CAST(0.5 AS DECIMAL(2,1)), 2) AS DOUBLE) AS clicks_mean,
  CAST(round_even((CAST(impr_min AS DECIMAL(28,10)) + CAST(impr_max AS DECIMAL(28,10))) * CAST(0.5 AS DECIMAL(2,1)), 2) AS DOUBLE) AS impressions_mean
FROM req JOIN resp USING (request_id)
""", "MA9,AG8,JO15,SF22,FI15")
def estimate_mean(spark, sf):
    from adlake.plans.operations import estimate_mean as em, unique_requests
    ev = _t(spark, sf).events
    k = F.get_json_object("props", "$.k").cast("double")
    keywords = ev.select(F.col("event_id").alias("request_id"), F.concat("event_type", F.lit("-"), F.col("user_id").cast("string")).alias("text"),
                         ((F.col("event_type") == "error") | (F.col("event_id") % 50 == 0)).alias("is_negative"))
    resp = ev.select(F.col("event_id").alias("request_id"), (F.col("value") / 3).alias("clicks_min"),
                     F.when(F.col("event_id") % 9 != 0, F.col("value") / 3 + k / 7).alias("clicks_max"),
                     (k / 1000).alias("impr_min"), (k / 1000 + 0.006).alias("impr_max"))
    return em(unique_requests(keywords), resp)


# ----------------------------------------------------------------- MA10
@register("trends_long", """
WITH counts AS (SELECT 'geo-' || CAST(user_id % 25 AS VARCHAR) AS geo, event_type || CAST(hour(ts) % 5 AS VARCHAR) AS keyword, count(*) AS n
                FROM events GROUP BY 1, 2),
batch AS (SELECT keyword, CAST(floor((row_number() OVER (ORDER BY keyword) - 1) / 3) AS BIGINT) AS batch_id FROM (SELECT DISTINCT keyword FROM counts))
SELECT batch_id, geo, keyword, n AS raw, (100 * n) // max(n) OVER (PARTITION BY batch_id) AS score
FROM (SELECT DISTINCT geo FROM counts) CROSS JOIN batch LEFT JOIN counts USING (geo, keyword)
""", "MA10,RS1,RS6,SE4")
def trends_long(spark, sf):
    from adlake.plans.operations import trends_long as tl
    ev = _t(spark, sf).events
    counts = ev.groupBy(F.concat(F.lit("geo-"), (F.col("user_id") % 25).cast("string")).alias("geo"),
                        F.concat("event_type", (F.hour("ts") % 5).cast("string")).alias("keyword")).agg(F.count("*").alias("n"))
    return tl(counts, "geo", "keyword", "n")


# ----------------------------------------------------------------- MA5
AVAILABLE_AS_OF = "2001-06-01"


@register("available_items", f"""
WITH open AS (
  SELECT DISTINCT l_partkey AS tour_id FROM lineitem
  WHERE CAST(l_shipdate AS DATE) >= DATE '{AVAILABLE_AS_OF}' - INTERVAL 1 DAY AND l_linestatus <> 'F' AND l_suppkey % 7 <> 0),
first_vendor AS (
  SELECT l_partkey AS id,
    (list(struct_pack(v := l_suppkey, a := CASE l_returnflag WHEN 'N' THEN NULL WHEN 'A' THEN false ELSE true END,
                      f := CASE WHEN l_quantity < 25 THEN 'ticket' ELSE 'voucher' END)
          ORDER BY l_linenumber, l_suppkey, (CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END), l_quantity >= 25))[1] AS x
  FROM lineitem GROUP BY 1)
SELECT open.tour_id, CASE WHEN p_size <> 7 THEN p_size END AS tour_group_id, p_name AS tour_name,
       CASE WHEN p_size <> 7 THEN 'group-' || CAST(p_size AS VARCHAR) END AS product_name,
       CASE WHEN x.v IS NULL THEN NULL WHEN x.a = false THEN 'No' ELSE 'Yes' END AS inventory_automated, x.f AS fulfillment_type,
       s_name AS vendor_name, CASE WHEN p_size <> 7 THEN n_name END AS city
FROM open SEMI JOIN (SELECT p_partkey AS tour_id FROM part WHERE p_type <> 'PROMO') USING (tour_id)
LEFT JOIN (FROM part WHERE p_size <> 13) p ON p.p_partkey = open.tour_id LEFT JOIN nation ON n_nationkey = p_size % 25
LEFT JOIN first_vendor ON first_vendor.id = p.p_partkey LEFT JOIN supplier ON s_suppkey = x.v
""", "MA5,AG7,JO1,JO10,WI6,FI3")
def available_items(spark, sf):
    from adlake.plans.operations import available_items as ai
    t = _t(spark, sf)
    li, part = t.lineitem, t.part
    slots = li.select(F.col("l_partkey").alias("tour_id"), F.col("l_shipdate").alias("inventory_date"),
                      (F.col("l_linestatus") == "F").alias("closed"),
                      F.nullif(F.col("l_suppkey") % 7, F.lit(0)).alias("price_profile_id"))
    catalogue = part.select(F.col("p_partkey").alias("id"),
                            F.when(F.col("p_type") == "PROMO", "INACTIVE").otherwise("ACTIVE").alias("status"))
    vt = li.select(F.col("l_partkey").alias("tour_id"), F.col("l_suppkey").alias("vendor_detail_id"),
                   F.col("l_linenumber").alias("priority"),
                   F.when(F.col("l_returnflag") == "N", F.lit(None).cast("boolean"))
                    .otherwise(F.col("l_returnflag") != "A").alias("is_inventory_automated"),
                   F.when(F.col("l_quantity") < 25, "ticket").otherwise("voucher").alias("fulfillment_type"))
    tour = part.where(F.col("p_size") != 13).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                                    F.col("p_size").alias("tour_group_id"))
    tg = (part.where(F.col("p_size") != 7).select("p_size").distinct()
          .join(F.broadcast(t.nation), F.pmod("p_size", F.lit(25)) == F.col("n_nationkey"))
          .select(F.col("p_size").alias("id"), F.concat(F.lit("group-"), F.col("p_size").cast("string")).alias("name"),
                  F.col("n_name").alias("city")))
    vd = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return ai(tour, tg, slots, catalogue, vt, vd, AVAILABLE_AS_OF)
