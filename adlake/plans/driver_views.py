"""Driver tables -> mart inputs.

The marts are written against the ad / operations domain; the test harness
only has TPC-H-like tables.  These functions derive each mart input from the
driver tables with plain column expressions (no sampling, no row caps), and
``SQL_*`` strings derive the same relations for the DuckDB oracle.

Mapping (ad row = lineitem, product = part):

* ad arm k = lineitem rows of one (l_returnflag, l_linestatus) pair, in the
  order of ``ARM_FLAGS``; week/year = Sunday week of l_shipdate
* sales = l_extendedprice, promo = price * l_discount, cost = price * l_tax,
  orders = l_quantity, clicks = l_linenumber, impressions = 100 * l_quantity
* keyword text = 'brand#' || (l_suppkey mod 25 + 1); search query =
  'Brand#' || (l_orderkey mod 25 + 1) || ' deals'
* product = part, brand = p_brand (NULL when p_size = 1),
  domain 'amazon.ca' for PROMO parts; scrap_rank 2 when p_size > 45
* phrase volume = Σ quantity per (year, week, keyword)
* daily status per part from its shipped lines
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.core import safe_divide, sunday_week, week_end_saturday, week_start_sunday

ARM_FLAGS = (("N", "O"), ("N", "F"), ("A", "F"), ("R", "F"), ("A", "O"), ("R", "O"))


def ad_lines(lineitem: DataFrame) -> DataFrame:
    d = F.to_date("l_shipdate")
    price, qty = F.col("l_extendedprice"), F.col("l_quantity")
    cost = price * F.col("l_tax")
    impressions = (qty * 100).cast("bigint")
    clicks = F.col("l_linenumber").cast("bigint")
    return lineitem.select(
        "l_returnflag", "l_linestatus",
        sunday_week(d).alias("week"), F.year(d).alias("year"),
        week_start_sunday(d).alias("week_start"), week_end_saturday(d).alias("week_end"),
        F.col("l_partkey").alias("branded_asin"),
        F.concat(F.lit("brand#"), (F.pmod("l_suppkey", F.lit(25)) + 1).cast("string")).alias("keyword_text"),
        F.when(F.col("l_discount") >= 0.06, F.concat(F.lit('asin="'), F.col("l_partkey").cast("string"), F.lit('"')))
         .when(F.col("l_discount") >= 0.03, F.concat(F.lit('category="'), F.col("l_returnflag"), F.lit('"')))
         .otherwise(F.concat(F.lit("auto-"), F.col("l_linenumber").cast("string"))).alias("targeting_text"),
        F.when(qty < 10, F.lit("EXACT")).when(qty < 30, F.lit("PHRASE")).otherwise(F.lit("BROAD")).alias("match_type"),
        F.concat(F.lit("Brand#"), (F.pmod("l_orderkey", F.lit(25)) + 1).cast("string"), F.lit(" deals")).alias("query"),
        cost.alias("cost"), impressions.alias("impressions"), clicks.alias("clicks"),
        qty.cast("bigint").alias("orders"), price.alias("sales"),
        safe_divide(clicks, impressions).alias("ctr"), safe_divide(cost, clicks).alias("cpc"),
        safe_divide(cost, price).alias("acos"),
        F.when(qty >= 45, F.lit(None).cast("bigint")).otherwise(qty.cast("bigint")).alias("h10_rank"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(price * 0.15).alias("fba_fees"),
        (price * 0.4).alias("cogs"),
        (price * F.col("l_discount")).alias("promo"),
        F.when(F.col("l_returnflag") == "R", price * 0.05).otherwise(F.lit(0.0)).alias("refunded"),
        (price * 0.01).alias("google_cost"),
        F.when(F.col("l_linenumber") == 1, price * 0.02).alias("dsp_cost"),
        (F.lit(0.6) + F.col("l_discount")).alias("ppc_incrementality_factor"),
    )


def ad_arms(lineitem: DataFrame) -> list[DataFrame]:
    lines = ad_lines(lineitem)
    return [lines.where((F.col("l_returnflag") == rf) & (F.col("l_linestatus") == ls))
            for rf, ls in ARM_FLAGS]


def products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("asin"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" for "), F.col("p_type"),
                 F.lit(" use, container "), F.col("p_brand"), F.lit(" edition "),
                 F.col("p_size").cast("string")).alias("title"),
        F.when(F.col("p_size") == 1, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("brand"),
        F.when(F.col("p_type") == "PROMO", F.lit("amazon.ca")).otherwise(F.lit("Amazon.com")).alias("amazon_domain"),
        F.when(F.col("p_size") > 45, F.lit(2)).otherwise(F.lit(1)).alias("scrap_rank"),
        F.lit(1).alias("bsr_tree_rank"),
    )


def phrase_volume(lineitem: DataFrame) -> DataFrame:
    d = F.to_date("l_shipdate")
    return (lineitem.select(
        F.year(d).alias("year"), sunday_week(d).alias("week"),
        F.concat(F.lit("brand#"), (F.pmod("l_suppkey", F.lit(25)) + 1).cast("string")).alias("phrase"),
        F.col("l_quantity").cast("bigint").alias("q"))
        .groupBy("year", "week", "phrase").agg(F.sum("q").alias("search_volume")))


def status_daily(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.to_date("l_shipdate").alias("update_date"),
        F.col("l_partkey").alias("child_asin"),
        F.when(F.col("l_linestatus") == "O", F.lit("New")).otherwise(F.lit("Active")).alias("product_status"),
        F.when(F.col("l_returnflag") == "A", F.lit("Liquidate"))
         .when(F.col("l_returnflag") == "R", F.lit("OVERSTOCK"))
         .otherwise(F.lit("Healthy")).alias("inventory_status"),
    )


# ----------------------------------------------------------------- SQL side

SQL_WEEK = "CAST(strftime({d}, '%U') AS INTEGER)"


def sql_week(d: str) -> str:
    return SQL_WEEK.format(d=d)


SQL_AD_LINES = f"""
ad_lines AS (
  SELECT l_returnflag, l_linestatus,
    {sql_week('CAST(l_shipdate AS DATE)')} AS week,
    year(l_shipdate) AS year,
    CAST(l_shipdate AS DATE) - CAST(dayofweek(l_shipdate) AS INTEGER) AS week_start,
    CAST(l_shipdate AS DATE) - CAST(dayofweek(l_shipdate) AS INTEGER) + 6 AS week_end,
    l_partkey AS branded_asin,
    'brand#' || CAST(l_suppkey % 25 + 1 AS VARCHAR) AS keyword_text,
    CASE WHEN l_discount >= 0.06 THEN 'asin="' || CAST(l_partkey AS VARCHAR) || '"'
         WHEN l_discount >= 0.03 THEN 'category="' || l_returnflag || '"'
         ELSE 'auto-' || CAST(l_linenumber AS VARCHAR) END AS targeting_text,
    CASE WHEN l_quantity < 10 THEN 'EXACT' WHEN l_quantity < 30 THEN 'PHRASE' ELSE 'BROAD' END AS match_type,
    'Brand#' || CAST(l_orderkey % 25 + 1 AS VARCHAR) || ' deals' AS query,
    l_extendedprice * l_tax AS cost,
    CAST(l_quantity * 100 AS BIGINT) AS impressions,
    CAST(l_linenumber AS BIGINT) AS clicks,
    CAST(l_quantity AS BIGINT) AS orders,
    l_extendedprice AS sales,
    CAST(l_linenumber AS BIGINT) / NULLIF(CAST(l_quantity * 100 AS BIGINT), 0) AS ctr,
    (l_extendedprice * l_tax) / NULLIF(CAST(l_linenumber AS BIGINT), 0) AS cpc,
    (l_extendedprice * l_tax) / NULLIF(l_extendedprice, 0) AS acos,
    CASE WHEN l_quantity >= 45 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS h10_rank,
    CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice * 0.15 END AS fba_fees,
    l_extendedprice * 0.4 AS cogs,
    l_extendedprice * l_discount AS promo,
    CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 0.05 ELSE 0.0 END AS refunded,
    l_extendedprice * 0.01 AS google_cost,
    CASE WHEN l_linenumber = 1 THEN l_extendedprice * 0.02 END AS dsp_cost,
    0.6 + l_discount AS ppc_incrementality_factor
  FROM lineitem
)"""

SQL_PRODUCTS = """
products AS (
  SELECT p_partkey AS asin,
    '  ' || p_name || ' for ' || p_type || ' use, container ' || p_brand || ' edition ' || CAST(p_size AS VARCHAR) AS title,
    CASE WHEN p_size = 1 THEN NULL ELSE p_brand END AS brand,
    CASE WHEN p_type = 'PROMO' THEN 'amazon.ca' ELSE 'Amazon.com' END AS amazon_domain,
    CASE WHEN p_size > 45 THEN 2 ELSE 1 END AS scrap_rank,
    1 AS bsr_tree_rank
  FROM part
)"""

SQL_PHRASE_VOLUME = f"""
phrase_volume AS (
  SELECT year(l_shipdate) AS year, {sql_week('CAST(l_shipdate AS DATE)')} AS week,
    'brand#' || CAST(l_suppkey % 25 + 1 AS VARCHAR) AS phrase,
    CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS search_volume
  FROM lineitem GROUP BY 1, 2, 3
)"""

SQL_STATUS_DAILY = """
status_daily AS (
  SELECT CAST(l_shipdate AS DATE) AS update_date, l_partkey AS child_asin,
    CASE WHEN l_linestatus = 'O' THEN 'New' ELSE 'Active' END AS product_status,
    CASE WHEN l_returnflag = 'A' THEN 'Liquidate' WHEN l_returnflag = 'R' THEN 'OVERSTOCK'
         ELSE 'Healthy' END AS inventory_status
  FROM lineitem
)"""


# ------------------------------------------------------------- MA2 inputs
# campaign = customer (o_custkey) on an order date; product id text = 'P' || partkey;
# an order's creative asins = its line parts ordered by line number.

def _asin(c) -> "F.Column":
    return F.concat(F.lit("P"), F.col(c).cast("string"))


def order_asins(lineitem: DataFrame) -> DataFrame:
    """Per order, the product ids of its lines by line number (bounded by the
    lines of one order)."""
    lines = lineitem.select("l_orderkey", F.struct("l_linenumber", _asin("l_partkey").alias("a")).alias("x"))
    return (lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x")).alias("xs"))
            .select("l_orderkey", F.transform("xs", lambda x: x["a"]).alias("asins")))


def campaigns_api(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    oa = order_asins(lineitem)
    o = orders.where(F.col("o_orderstatus") == "F")
    j = o.join(oa, F.col("o_orderkey") == F.col("l_orderkey"))
    camp = F.struct(F.col("o_custkey").alias("campaignid"), F.struct(F.col("asins").alias("asins")).alias("creative"))
    return j.select(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("report_date")).alias("params"),
                    F.array(F.struct(F.array(camp).alias("campaigns"))).alias("payload"))


AD_GROUP_PRIORITIES = (("1-URGENT",), ("2-HIGH",), ("3-MEDIUM",), ("4-NOT SPECIFIED", "5-LOW"))


def ad_groups(orders: DataFrame, lineitem: DataFrame) -> list[DataFrame]:
    oa = order_asins(lineitem)
    j = orders.join(oa, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    name = F.concat(F.lit("cmp "), F.col("o_orderpriority"), F.lit(" "),
                    F.coalesce(F.array_join("asins", "+"), F.lit("none")))
    base = j.select(F.col("o_custkey").alias("campaign_id"), name.alias("campaign_name"),
                    F.to_date("o_orderdate").alias("report_date"), "o_orderpriority")
    return [base.where(F.col("o_orderpriority").isin(*ps)).drop("o_orderpriority") for ps in AD_GROUP_PRIORITIES]


def product_master(part: DataFrame) -> DataFrame:
    cur = part.select(_asin("p_partkey").alias("child_asin"), F.col("p_brand").alias("brand"),
                      F.to_date(F.lit("2024-01-01")).alias("last_updated_date"))
    old = part.where(F.col("p_size") < 5).select(_asin("p_partkey").alias("child_asin"), F.lit("OLD").alias("brand"),
                                                 F.to_date(F.lit("2023-06-01")).alias("last_updated_date"))
    return cur.unionByName(old)


def pnl(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(F.to_date("l_shipdate").alias("purchased_date_utc"), _asin("l_partkey").alias("asin"),
                           F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
                            .otherwise(F.col("l_extendedprice")).alias("item_price_usd"))


def bulk_ops(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    o = orders.where(F.col("o_orderpriority") == "5-LOW").select("o_orderkey", "o_custkey")
    j = o.join(lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select(F.col("o_custkey").alias("campaign_id"),
                    *[F.when(F.col("l_linenumber") == i, _asin("l_partkey")).alias(f"creative_asins{i}")
                      for i in (1, 2, 3)])


SQL_MA2_INPUTS = """
order_asins AS (
  SELECT l_orderkey, list(a ORDER BY l_linenumber, a) AS asins
  FROM (SELECT l_orderkey, l_linenumber, 'P' || CAST(l_partkey AS VARCHAR) AS a FROM lineitem) GROUP BY 1),
api_rows AS (
  SELECT CAST(o.o_orderdate AS DATE) AS report_date, o.o_custkey AS campaign_id,
         oa.asins[1] AS creative_asin1, oa.asins[2] AS creative_asin2, oa.asins[3] AS creative_asin3
  FROM orders o JOIN order_asins oa ON o.o_orderkey = oa.l_orderkey WHERE o.o_orderstatus = 'F'),
ad_groups AS (
  SELECT o.o_custkey AS campaign_id,
         'cmp ' || o.o_orderpriority || ' ' || COALESCE(array_to_string(oa.asins, '+'), 'none') AS campaign_name,
         CAST(o.o_orderdate AS DATE) AS report_date
  FROM orders o LEFT JOIN order_asins oa ON o.o_orderkey = oa.l_orderkey),
product_master AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS child_asin, p_brand AS brand, DATE '2024-01-01' AS last_updated_date FROM part
  UNION ALL
  SELECT 'P' || CAST(p_partkey AS VARCHAR), 'OLD', DATE '2023-06-01' FROM part WHERE p_size < 5),
pnl AS (
  SELECT CAST(l_shipdate AS DATE) AS purchased_date_utc, 'P' || CAST(l_partkey AS VARCHAR) AS asin,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS item_price_usd FROM lineitem),
bulk AS (
  SELECT o.o_custkey AS campaign_id,
         CASE WHEN l.l_linenumber = 1 THEN 'P' || CAST(l.l_partkey AS VARCHAR) END AS creative_asins1,
         CASE WHEN l.l_linenumber = 2 THEN 'P' || CAST(l.l_partkey AS VARCHAR) END AS creative_asins2,
         CASE WHEN l.l_linenumber = 3 THEN 'P' || CAST(l.l_partkey AS VARCHAR) END AS creative_asins3
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE o.o_orderpriority = '5-LOW')"""


# ------------------------------------------------------------- MA3 inputs
# a rank reading = an event: product = user_id, phrase = event_type,
# rank text = props.k (a non-number for error events), niche = user mod 25 -> nation,
# marketplace = the nation's region name.

def rank_raw(events: DataFrame) -> DataFrame:
    return events.select(F.col("ts").alias("timestamp_ingested"), F.col("user_id").alias("asin"),
                         F.col("event_type").alias("phrase"),
                         F.when(F.col("event_type") == "error", F.lit("x"))
                          .otherwise(F.get_json_object("props", "$.k")).alias("rank"),
                         F.pmod("user_id", F.lit(25)).alias("niche_id"))


def niche_master(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("niche_id"), F.col("r_name").alias("marketplace_id"))


def date_dimension(events: DataFrame) -> DataFrame:
    d = events.select(F.to_date("ts").alias("full_date")).distinct()
    return d.select("full_date", sunday_week("full_date").alias("week_number"), F.year("full_date").alias("year"))


SQL_MA3_INPUTS = f"""
rank_raw AS (
  SELECT ts AS timestamp_ingested, user_id AS asin, event_type AS phrase,
         CASE WHEN event_type = 'error' THEN 'x' ELSE json_extract_string(props, '$.k') END AS rank,
         user_id % 25 AS niche_id FROM events),
niche_master AS (
  SELECT CAST(n_nationkey AS BIGINT) AS niche_id, r_name AS marketplace_id
  FROM nation JOIN region ON n_regionkey = r_regionkey),
date_dimension AS (
  SELECT full_date, {sql_week('full_date')} AS week_number, year(full_date) AS year
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS full_date FROM events))"""


# ------------------------------------------------------------- MA4 inputs
# search-term row = a line item; traffic by day = orders of that day.

def _dec_product(a: str, b: str):
    return (F.col(a).cast("decimal(18,2)") * F.col(b).cast("decimal(18,2)")).cast("double")


def _ptype(c: str):
    return F.when(F.pmod(c, F.lit(8)) < 4, F.lit("widgets")).otherwise(F.lit("gizmos"))


def search_terms(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.to_date("l_shipdate").alias("Date"),
        F.concat(F.lit("brand#"), (F.pmod("l_suppkey", F.lit(25)) + 1).cast("string")).alias("Customer_Search_Term"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("tgt-"), F.col("l_returnflag"), F.col("l_linestatus"))).alias("Targeting"),
        F.concat(F.lit("camp-"), F.pmod("l_partkey", F.lit(10)).cast("string")).alias("campaign_name"),
        F.concat(F.lit("ag-"), F.pmod("l_partkey", F.lit(8)).cast("string")).alias("ad_group_name"),
        _dec_product("l_extendedprice", "l_tax").alias("spend"),
        F.col("l_quantity").cast("bigint").alias("Clicks"),
        F.col("l_extendedprice").alias("_14_Day_Total_Sales"))


def sales_traffic(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.to_date("o_orderdate").alias("Date")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("Ordered_Product_Sales"),
        F.count("*").alias("sessions_total"),
        (F.count("*") * 2).alias("Units_Ordered"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("bigint").alias("Total_Order_Items"),
        F.sum(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).cast("bigint").alias("Units_Refunded"),
        F.count_distinct("o_custkey").alias("Feedback_Received"))


def campaign_map(part: DataFrame) -> DataFrame:
    k10, k8 = F.pmod("p_partkey", F.lit(10)).cast("string"), F.pmod("p_partkey", F.lit(8)).cast("string")
    main = part.select(F.concat(F.lit("camp-"), k10).alias("campaign"), F.concat(F.lit("CAMP-"), k10).alias("campaign_new"),
                       F.concat(F.lit("ag-"), k8).alias("ad_group"), F.concat(F.lit("AG-"), k8).alias("ad_group_new"),
                       _ptype("p_partkey").alias("product_type"))
    alt = part.where(F.col("p_partkey") == 3).select(
        F.lit("camp-3").alias("campaign"), F.lit("CAMP-3-ALT").alias("campaign_new"), F.lit("ag-3").alias("ad_group"),
        F.lit("AG-3").alias("ad_group_new"), F.lit("widgets").alias("product_type"))
    return main.unionByName(alt)


def asin_traffic(lineitem: DataFrame) -> DataFrame:
    pt = (F.when(F.pmod("l_suppkey", F.lit(3)) == 0, F.lit("widgets"))
          .when(F.pmod("l_suppkey", F.lit(3)) == 1, F.lit("gizmos")).otherwise(F.lit("spares")))
    return lineitem.select(F.to_date("l_shipdate").alias("Date"), pt.alias("product_type"),
                           F.lit(1).cast("bigint").alias("sessions_total"),
                           F.col("l_quantity").cast("bigint").alias("page_views_total"),
                           F.col("l_quantity").cast("bigint").alias("units_ordered"),
                           F.col("l_linenumber").cast("bigint").alias("total_order_items"),
                           F.col("l_extendedprice").alias("ordered_product_sales"))


SQL_MA4_INPUTS = """
search_terms AS (
  SELECT CAST(l_shipdate AS DATE) AS Date, 'brand#' || CAST(l_suppkey % 25 + 1 AS VARCHAR) AS Customer_Search_Term,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 'tgt-' || l_returnflag || l_linestatus END AS Targeting,
    'camp-' || CAST(l_partkey % 10 AS VARCHAR) AS campaign_name, 'ag-' || CAST(l_partkey % 8 AS VARCHAR) AS ad_group_name,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS spend,
    CAST(l_quantity AS BIGINT) AS Clicks, l_extendedprice AS _14_Day_Total_Sales
  FROM lineitem),
sales_traffic AS (
  SELECT CAST(o_orderdate AS DATE) AS Date,
    CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS Ordered_Product_Sales,
    count(*) AS sessions_total, count(*) * 2 AS Units_Ordered,
    CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS Total_Order_Items,
    CAST(SUM(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS Units_Refunded,
    count(DISTINCT o_custkey) AS Feedback_Received
  FROM orders GROUP BY 1),
campaign_map AS (
  SELECT 'camp-' || CAST(p_partkey % 10 AS VARCHAR) AS campaign, 'CAMP-' || CAST(p_partkey % 10 AS VARCHAR) AS campaign_new,
    'ag-' || CAST(p_partkey % 8 AS VARCHAR) AS ad_group, 'AG-' || CAST(p_partkey % 8 AS VARCHAR) AS ad_group_new,
    CASE WHEN p_partkey % 8 < 4 THEN 'widgets' ELSE 'gizmos' END AS product_type FROM part
  UNION ALL
  SELECT 'camp-3', 'CAMP-3-ALT', 'ag-3', 'AG-3', 'widgets' FROM part WHERE p_partkey = 3),
asin_traffic AS (
  SELECT CAST(l_shipdate AS DATE) AS Date,
    CASE WHEN l_suppkey % 3 = 0 THEN 'widgets' WHEN l_suppkey % 3 = 1 THEN 'gizmos' ELSE 'spares' END AS product_type,
    CAST(1 AS BIGINT) AS sessions_total, CAST(l_quantity AS BIGINT) AS page_views_total,
    CAST(l_quantity AS BIGINT) AS units_ordered, CAST(l_linenumber AS BIGINT) AS total_order_items,
    l_extendedprice AS ordered_product_sales
  FROM lineitem)"""
