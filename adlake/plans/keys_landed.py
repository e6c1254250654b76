"""Registered keys for landed files, reports, incremental models, snapshots and
streams (§2.2, SK1, SK2, SK8, SK9, RS7, ST1, ST2).

Each lands a driver table in the session's shared scratch folder as files of
the kind its source delivers, and returns what the reader, sink or stream made
of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.plans import driver_views as dv
from adlake.plans.keys_marts import _SNAP_SQL, WEEKLY_RANK_MARKET, WEEKLY_RANK_SQL, _snapshots, alert_inputs
from adlake.plans.registry import register
from adlake.session import scratch_path
from adlake.sources.tables import Tables


def _t(spark, sf):
    return Tables(spark, sf)


# ---------------------------------------------------------------- landed files

LANDED = "order_no bigint, day date, amount decimal(12,2), priority string"


@register("landed_csv", """
SELECT CAST(o_orderkey AS BIGINT) AS order_no, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DOUBLE) AS amount, o_orderpriority AS priority,
       o_orderstatus = 'P' AS rejected
FROM orders
""", "SC2,SK8")
def landed_csv(spark, sf):
    """Orders as daily reports bring them: a junk line, a header of other
    names, then rows, some with a day that is no date.  The junk line and the
    header of every file are skipped; rows that don't parse are kept apart."""
    from adlake.sources.files import read_csv_renamed
    o = _t(spark, sf).orders
    path = scratch_path(spark, "landed-csv")
    day = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("on "), F.to_date("o_orderdate").cast("string"))).otherwise(F.to_date("o_orderdate").cast("string"))
    titles = ["Order", "Order Date", "Total", "Priority"]
    row = F.struct(F.col("o_orderkey").cast("string"), day, F.col("o_totalprice").cast("decimal(12,2)").cast("string"), F.col("o_orderpriority"))
    lines = o.select(F.to_csv(row).alias("value"), F.year("o_orderdate").alias("year"))
    heads = lines.select("year").distinct().select(
        F.explode(F.array(F.struct(F.lit(0).alias("no"), F.lit("report of the year,,,").alias("value")),
                          F.struct(F.lit(1).alias("no"), F.to_csv(F.struct(*[F.lit(x).alias(f"c{i}") for i, x in enumerate(titles)])).alias("value")))).alias("h"), "year")
    both = heads.select("h.no", "h.value", "year").unionByName(lines.select(F.lit(2).alias("no"), "value", "year"))
    both.repartition("year").sortWithinPartitions("year", "no").select("value", "year").write.partitionBy("year").text(path)
    rows, rejected = read_csv_renamed(spark, f"{path}/year=*", T.StructType.fromDDL(LANDED), titles)
    late = rejected.select(F.col("order_no").cast("bigint").alias("order_no"), F.to_date(F.substring("day", 4, 10)).alias("day"),
                           F.col("amount").cast("double").alias("amount"), "priority", F.array_contains("failed_rules", "day").alias("rejected"))
    return rows.select("order_no", "day", F.col("amount").cast("double").alias("amount"), "priority", F.lit(False).alias("rejected")).unionByName(late)


@register("landed_csv_header", """
SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part
""", "SC3,SK8")
def landed_csv_header(spark, sf):
    """Parts through a dated CSV report with a header and back."""
    from adlake.sources.files import read_csv
    from adlake.sources.sinks import write_csv_report
    p = _t(spark, sf).part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    out = write_csv_report(p, scratch_path(spark, "reports"), "parts", "2024-01-31")
    return read_csv(spark, out, p.schema)


@register("landed_json", """
SELECT event_id, user_id, event_type, value, json_extract_string(props, '$.k') AS k, CAST(ts AS DATE) AS day FROM events
""", "SC4")
def landed_json(spark, sf):
    """Events as JSON records, nested ones included, read by a given schema."""
    from adlake.sources.files import read_json_records
    ev = _t(spark, sf).events.select("event_id", "user_id", "event_type", "value", F.from_json("props", "map<string,string>").alias("props"), F.to_date("ts").alias("day"))
    path = scratch_path(spark, "landed-json")
    ev.write.json(path)
    schema = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, value double, props struct<k: string>, day date")
    return read_json_records(spark, path, schema).select("event_id", "user_id", "event_type", "value", F.col("props.k").alias("k"), "day")


@register("json_grid", """
SELECT n_nationkey AS nation, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) - 1 AS INTEGER) AS row_pos,
       CAST(s_suppkey AS VARCHAR) AS supplier, s_name AS title
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""", "RS7")
def json_grid(spark, sf):
    """A sheet of rows for each nation, as JSON text, back to rows."""
    from adlake.sources.files import rows_from_json_grid
    t = _t(spark, sf)
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    sheets = s.groupBy("n_nationkey").agg(F.sort_array(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("rows"))
    cells = F.transform("rows", lambda r: F.array(F.lit(0).cast("string"), r["s_suppkey"].cast("string"), r["s_name"]))
    sheets = sheets.select(F.to_json(F.transform(cells, lambda c: F.array(F.col("n_nationkey").cast("string"), F.get(c, 1), F.get(c, 2)))).alias("sheet"))
    rows = rows_from_json_grid(sheets, "sheet", ["nation", "supplier", "title"])
    return rows.select(F.col("nation").cast("int").alias("nation"), F.col("row_pos").cast("int").alias("row_pos"), "supplier", "title")


# ---------------------------------------------------- full and incremental models

@register("full_replace", """
SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_returnflag = 'R'
""", "SK1")
def full_replace(spark, sf):
    """A table partitioned by month of day is written whole, then replaced
    whole by a smaller one: nothing of the first is left."""
    from adlake.sources.sinks import write_full
    li = _t(spark, sf).lineitem
    rows = li.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.to_date("l_shipdate").alias("day"), F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    path = scratch_path(spark, "full")
    write_full(rows.drop("l_returnflag"), path, ["month"])
    write_full(rows.where("l_returnflag = 'R'").drop("l_returnflag"), path, ["month"])
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_quantity", "day")


INCREMENTAL_RUNS = ("2024-01-12", "2024-01-19", None)  # readings up to these days, then all


@register("weekly_rank_incremental", WEEKLY_RANK_SQL, "SK2,MA3")
def weekly_rank_incremental(spark, sf):
    """The weekly rank as an incremental model: a first full run, then runs
    that scan the readings since the target's high-water mark alone.  The
    result must equal the full model over all readings."""
    from adlake.plans.weekly_rank import land_readings, run_incremental
    t = _t(spark, sf)
    source, path = scratch_path(spark, "rank-raw"), scratch_path(spark, "rank-model")
    landed = None
    for to in INCREMENTAL_RUNS:
        new = dv.rank_raw(t.events)
        day = F.to_date("timestamp_ingested")
        new = new.where(F.lit(True) if landed is None else day > F.lit(landed)).where(F.lit(True) if to is None else day <= F.lit(to))
        land_readings(new, source)
        run_incremental(spark, source, dv.niche_master(t.nation, t.region), dv.date_dimension(t.events), WEEKLY_RANK_MARKET, path)
        landed = to
    return spark.read.parquet(path).select("unique_key", "year", "week", "wc_date", "we_date", "asin", "phrase", "h10_rank")


@register("snapshot_rotate", f"""
WITH {_SNAP_SQL},
runs AS (SELECT run_id, row_number() OVER (ORDER BY run_id DESC) AS back FROM (SELECT DISTINCT run_id FROM snap))
SELECT cur.tour_id, cur.slots AS current_slots, prev.slots AS previous_slots
FROM (SELECT * FROM snap JOIN runs USING (run_id) WHERE back = 1) cur
LEFT JOIN (SELECT * FROM snap JOIN runs USING (run_id) WHERE back = 2) prev USING (tour_id)
""", "SK9,JO13")
def snapshot_rotate(spark, sf):
    """Every run's slots rotate into a table of two generations, in order; the
    last run then stands beside the one before it."""
    from adlake.operators.lookup import first_match_lookup
    from adlake.sources.versioned import VersionedTable
    snap = _snapshots(spark, sf)
    table = VersionedTable(spark, scratch_path(spark, "slots"))
    for run in snap.select("run_id").distinct().orderBy("run_id").collect():  # a row a run
        table.rotate(snap.where(F.col("run_id") == run["run_id"]))
    previous = first_match_lookup(table.previous(), "tour_id", "row_no", ["slots"]).withColumnRenamed("slots", "previous_slots")
    current = table.read().select("tour_id", F.col("slots").alias("current_slots"))
    return current.join(previous, "tour_id", "left").select("tour_id", "current_slots", "previous_slots")


# ---------------------------------------------------------------------- streams

UPSERTS = (("1992-01-01", "1998-03-01", 1), ("1997-06-01", "1998-05-01", 2), ("1998-02-01", "1999-01-01", 3))


@register("streamed_upsert", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice * v AS price
FROM orders, (VALUES {", ".join(f"(DATE '{a}', DATE '{b}', {v}, DATE '{UPSERTS[i + 1][0] if i + 1 < len(UPSERTS) else '9999-01-01'}')" for i, (a, b, v) in enumerate(UPSERTS))}) u(lo, hi, v, upto)
WHERE CAST(o_orderdate AS DATE) >= lo AND CAST(o_orderdate AS DATE) < hi AND CAST(o_orderdate AS DATE) < upto
""", "ST2,SK3")
def streamed_upsert(spark, sf):
    """Three landings of orders, each from an own day on and with corrected
    prices, through the upsert stream."""
    from adlake.sources.versioned import VersionedTable
    from adlake.streaming.upsert import run_versioned_upsert
    o = _t(spark, sf).orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    base = scratch_path(spark, "upsert-stream")
    for lo, hi, v in UPSERTS:
        part = o.where((F.col("day") >= lo) & (F.col("day") < hi)).select("o_orderkey", "day", (F.col("o_totalprice") * v).alias("price"))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")  # a landing is a file
    run_versioned_upsert(spark, f"{base}/in", part.schema, f"{base}/table", "day", f"{base}/checkpoint").awaitTermination()
    return VersionedTable(spark, f"{base}/table").read().select("o_orderkey", "day", "price")


ARRIVAL_DAYS = 5  # a landing
LATE_EVERY, LATE_DAYS = 40, 6  # of the events, these arrive so much later

_ALERT_SQL = f"""
WITH cost AS (
  SELECT 'account-' || CAST(user_id % 5 AS VARCHAR) AS account, user_id AS campaign_id, 'Campaign-' || CAST(user_id AS VARCHAR) AS name,
         event_type <> 'error' AS enabled, ts, epoch_ms(ts) AS ms, CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 AS budget,
         CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE) + to_days(CASE WHEN event_id % {LATE_EVERY} = 0 THEN {LATE_DAYS} ELSE 0 END)) / {ARRIVAL_DAYS}) AS BIGINT) AS landing
  FROM events),
marks AS (
  SELECT landing, coalesce(max(most) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1200000, 0) AS mark
  FROM (SELECT landing, max(ms) FILTER (WHERE enabled) AS most FROM cost GROUP BY 1)),
config AS (
  SELECT 'account-' || CAST(n_nationkey % 5 AS VARCHAR) AS account, CASE n_nationkey % 5 WHEN 3 THEN 'n/a' ELSE CAST(30 + n_nationkey AS VARCHAR) END AS pct,
         CAST(1 + n_nationkey % 5 AS VARCHAR) AS min_abs, lower(n_name) AS contact, n_nationkey AS pos FROM nation),
limits AS (
  SELECT account, TRY_CAST(arg_max(pct, pos) AS DOUBLE) AS pct, TRY_CAST(arg_max(min_abs, pos) AS DOUBLE) AS min_abs, arg_max(contact, pos) AS contact
  FROM config GROUP BY 1 HAVING TRY_CAST(arg_max(pct, pos) AS DOUBLE) > 0 AND TRY_CAST(arg_max(min_abs, pos) AS DOUBLE) > 0),
hours AS (
  SELECT account, campaign_id, max(name) AS name, ms // 3600000 AS h, CAST(sum(cents) AS BIGINT) AS today, CAST(sum(budget) AS BIGINT) AS budget
  FROM cost JOIN marks USING (landing) WHERE enabled AND ms > mark GROUP BY ALL),
shut AS (
  SELECT a.*, coalesce((SELECT sum(b.today) FROM hours b WHERE b.campaign_id = a.campaign_id AND b.h IN (a.h - 168, a.h - 336, a.h - 504, a.h - 672)), 0) / 100.0 / 4 AS average
  FROM hours a WHERE (h + 1) * 3600000 <= (SELECT max(ms) - 1200000 FROM cost WHERE enabled)),
d AS (SELECT *, today / 100.0 - average AS difference,
             CASE WHEN average = 0 THEN CAST('inf' AS DOUBLE) ELSE (today / 100.0 - average) / average * 100.0 END AS pct_change FROM shut)
SELECT account, contact, campaign_id, name, CAST(h AS BIGINT) AS hour_no, today / 100.0 AS today, budget / 100.0 AS budget, average, difference, pct_change, pct
FROM d JOIN limits USING (account) WHERE difference >= min_abs AND abs(pct_change) > pct
"""


@register("streamed_spend_alerts", _ALERT_SQL, "ST1,MA7,FI14")
def streamed_spend_alerts(spark, sf):
    """All events through the stateful alert stream, in landings of five days;
    every fortieth event arrives six days late and must change nothing."""
    from adlake.plans.operations import AlertParams
    from adlake.streaming.spend_state import run_state_alerts
    base = scratch_path(spark, "alert-stream")
    arrival = F.date_add(F.to_date("ts"), F.when(F.col("event_id") % LATE_EVERY == 0, LATE_DAYS).otherwise(0))
    rows, config = alert_inputs(spark, sf, F.floor(F.datediff(arrival, F.lit("2024-01-01").cast("date")) / ARRIVAL_DAYS).alias("landing"))
    cost = rows.drop("landing")
    for no in [r["landing"] for r in rows.select("landing").distinct().orderBy("landing").collect()]:  # seven or so
        rows.where(F.col("landing") == no).drop("landing").coalesce(1).write.mode("append").parquet(f"{base}/in")
    run_state_alerts(spark, f"{base}/in", cost.schema, config, AlertParams("", 0), f"{base}/alerts", f"{base}/checkpoint").awaitTermination()
    out = spark.read.schema("account string, contact string, campaign_id long, name string, hour_start timestamp, today double, budget double, "
                            "average double, difference double, pct_change double, pct double").parquet(f"{base}/alerts")
    return out.select("account", "contact", "campaign_id", "name", F.expr("unix_millis(hour_start) div 3600000").alias("hour_no"),
                      "today", "budget", "average", "difference", "pct_change", "pct")
