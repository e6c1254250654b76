"""Registered keys for sinks and ingestion (SK3-SK7, SC8, MA8).

These keys run a write into a fresh folder under the session's checkpoint
directory (the shared folder named by ``spark.checkpoint.dir``) and return
the written table read back, so the result reflects the sink semantics.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.relational import union_all_by_name
from adlake.operators.schema import add_columns_if_missing, fill_numeric_and_text, normalise
from adlake.plans.registry import register
from adlake.session import scratch_path
from adlake.sources.sinks import append_with_quarantine as awq, max_dates
from adlake.sources.tables import Tables
from adlake.sources.versioned import VersionedTable

REPLACE_BATCH = ("1998-01-01", "1998-03-01")
INGEST_AS_OF, INGEST_LOOKBACK = "2001-06-01", 180
SALES_LOADED_TO = {"SG": "2000-03-31", "MY": "2000-09-30"}


@register("replace_from_date", f"""
SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS report_date FROM orders
WHERE CAST(o_orderdate AS DATE) < DATE '{REPLACE_BATCH[0]}'
UNION ALL
SELECT o_orderkey, o_totalprice * 2, CAST(o_orderdate AS DATE) FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '{REPLACE_BATCH[0]}' AND CAST(o_orderdate AS DATE) < DATE '{REPLACE_BATCH[1]}'
""", "SK3,FI9,SC10")
def replace_from_date(spark, sf):
    """The whole history is loaded, then a corrected batch for Jan-Feb 1998
    replaces everything from its first day: all later partitions of the
    history must disappear."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("report_date"))
    table = VersionedTable(spark, scratch_path(spark, "replace"))
    table.replace_from(o, "report_date")
    batch = o.where((F.col("report_date") >= REPLACE_BATCH[0]) & (F.col("report_date") < REPLACE_BATCH[1]))
    table.replace_from(batch.withColumn("o_totalprice", F.col("o_totalprice") * 2), "report_date", start=REPLACE_BATCH[0])
    return table.read().select("o_orderkey", "o_totalprice", "report_date")


def _region_orders(t, country: str, nations, with_details: bool):
    c = t.customer.where(F.col("c_nationkey").isin(*nations)).select("c_custkey")
    o = t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    o = o.select(F.col("o_orderkey").alias("PO_NUMBER"), F.col("o_custkey").alias("VENDOR"),
                 F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 50000), F.lit(None).cast("date"))
                  .otherwise(F.to_date("o_orderdate")).alias("PO_DATE"),
                 F.col("o_totalprice").alias("AMOUNT"),
                 F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
                  .otherwise(F.col("o_orderpriority")).alias("NOTE"),
                 F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("double"))
                  .otherwise(F.col("o_totalprice") / 100).alias("TAX"),
                 *([F.col("o_orderstatus").alias("SO_DETAILS2")] if with_details else []))
    o = add_columns_if_missing(o, {"SO_DETAILS2": None})
    o = o.withColumn("SO_DETAILS2", F.col("SO_DETAILS2").cast("string"))
    o = normalise(o, lower=True, move={"po_date": 0})
    return o.withColumn("country", F.lit(country))


@register("ingest_two_regions", f"""
WITH src AS (
  SELECT o_orderkey AS po_number, o_custkey AS vendor,
    CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS po_date,
    o_totalprice AS amount, COALESCE(CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END, '0') AS note,
    COALESCE(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice / 100 END, 0) AS tax,
    COALESCE(CASE WHEN c_nationkey < 12 THEN o_orderstatus END, '0') AS so_details2,
    CASE WHEN c_nationkey < 12 THEN 'SG' ELSE 'MY' END AS country
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT po_number, vendor, po_date,
  CASE WHEN po_date >= DATE '{INGEST_AS_OF}' - INTERVAL {INGEST_LOOKBACK} DAY THEN amount * 2 ELSE amount END AS amount,
  note, tax, so_details2, country
FROM src WHERE po_date IS NOT NULL
""", "MA8,SK4,SC9,PR7,PR8,PR9,PR10,PR12,PR13,SE4,FI4,SF1,S9")
def ingest_two_regions(spark, sf):
    """Purchase orders of both regions: the whole history, then each region's
    last 180 days once more, with corrected amounts."""
    t = Tables(spark, sf)
    sg = _region_orders(t, "SG", list(range(0, 12)), True)
    my = _region_orders(t, "MY", list(range(12, 25)), False)
    allr = fill_numeric_and_text(union_all_by_name([sg, my]).dropna(subset=["po_date"]))
    table = VersionedTable(spark, scratch_path(spark, "purchases"))
    table.replace_from(allr, "po_date", scope=["country"])
    since = F.date_sub(F.to_date(F.lit(INGEST_AS_OF)), INGEST_LOOKBACK)
    start = spark.range(1).select(since.alias("d")).first()["d"]
    batch = allr.where(F.col("po_date") >= since).withColumn("amount", F.col("amount") * 2)
    table.replace_from(batch, "po_date", start=start, scope=["country"])
    return table.read().select("po_number", "vendor", "po_date", "amount", "note", "tax",
                                           "so_details2", "country")


@register("replace_region_from_date", f"""
WITH src AS (
  SELECT o_orderkey AS document_no, CAST(o_orderdate AS DATE) AS posting_date, o_totalprice AS local_net_sales,
    n_name AS warehouse_code, CASE WHEN c_nationkey < 12 THEN 'SG' ELSE 'MY' END AS country
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
loaded AS (
  SELECT * FROM src WHERE posting_date <= CASE country WHEN 'SG' THEN DATE '{SALES_LOADED_TO["SG"]}' ELSE DATE '{SALES_LOADED_TO["MY"]}' END),
latest AS (SELECT country, max(posting_date) AS day FROM loaded GROUP BY 1)
SELECT document_no, posting_date, CASE WHEN posting_date >= day THEN local_net_sales * 2 ELSE local_net_sales END AS local_net_sales,
  warehouse_code, country
FROM src JOIN latest USING (country)
""", "SK4,SC8,MA8")
def replace_region_from_date(spark, sf):
    """Sales invoices of both regions, loaded up to different days: each region
    goes on from its own last loaded day, which is ingested once more."""
    t = Tables(spark, sf)
    src = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("o_orderkey").alias("document_no"), F.to_date("o_orderdate").alias("posting_date"),
        F.col("o_totalprice").alias("local_net_sales"), F.col("n_name").alias("warehouse_code"),
        F.when(F.col("c_nationkey") < 12, "SG").otherwise("MY").alias("country")))
    table = VersionedTable(spark, scratch_path(spark, "sales"))
    to = F.when(F.col("country") == "SG", F.lit(SALES_LOADED_TO["SG"])).otherwise(F.lit(SALES_LOADED_TO["MY"]))
    table.replace_from(src.where(F.col("posting_date") <= to.cast("date")), "posting_date", scope=["country"])
    cursor = max_dates(table.read(), "country", "posting_date")
    batch = None
    for country, day in sorted(cursor.items()):  # one request a region, as each has its own day
        own = src.where((F.col("country") == country) & (F.col("posting_date") >= F.lit(day)))
        batch = own if batch is None else batch.unionByName(own)
    if batch is not None:
        table.replace_from(batch.withColumn("local_net_sales", F.col("local_net_sales") * 2), "posting_date", start=cursor, scope=["country"])
    return table.read().select("document_no", "posting_date", "local_net_sales", "warehouse_code", "country")


@register("append_with_quarantine", """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day,
  concat_ws(',', CASE WHEN NOT coalesce(value > 0, false) THEN 'positive_value' END,
            CASE WHEN NOT coalesce(event_type <> 'error', false) THEN 'not_error' END,
            CASE WHEN json_extract_string(props, '$.k') IS NULL THEN 'has_k' END) AS failed_rules
FROM events
""", "SK6,SK5,SK7")
def append_with_quarantine(spark, sf):
    """Both sides of a day-partitioned append in files of at most 6,000 rows."""
    ev = Tables(spark, sf).events.select("event_id", "user_id", "event_type", "value", "props", F.to_date("ts").alias("day"))
    rules = {"positive_value": F.col("value") > 0, "not_error": F.col("event_type") != "error",
             "has_k": F.get_json_object("props", "$.k").isNotNull()}
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    awq(ev, good, bad, rules, partition_by=["day"], max_records_per_file=6000)
    cols = ["event_id", "user_id", "event_type", "value", "day"]
    sides = [spark.read.schema(ev.schema).parquet(good).select(*cols, F.lit("").alias("failed_rules"))]
    bad_schema = T.StructType([*ev.schema.fields, T.StructField("failed_rules", T.ArrayType(T.StringType()))])
    sides.append(spark.read.schema(bad_schema).parquet(bad).select(*cols, F.array_join("failed_rules", ",").alias("failed_rules")))
    return sides[0].unionByName(sides[1])
