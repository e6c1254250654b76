"""Operations marts: available items (MA5), inventory change (MA6), spend
alerts (MA7), keyword estimates (MA9) and trend scores (MA10).

Run dates, thresholds and bands are parameters; "previous run" and other
scalars are scalar subqueries (``DataFrame.scalar``), never driver collects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.operators.filters import banded_flag, name_filter
from adlake.operators.lookup import first_match_lookup, last_match_lookup
from adlake.operators.relational import first_by_priority
from adlake.operators.reshape import global_rank, positions
from adlake.session import materialise

# Stock bands (low, high, change threshold) for the drop flag;
# a band matches when low <= current <= high and change < threshold.
DROP_BANDS = ((0, 10, -6), (11, 50, -8), (51, 150, -10), (151, 400, -15), (401, 1000, -20), (1001, None, -40))


def _round_half_up(c: Column, n: int) -> Column:
    return F.round(c.cast("decimal(38,10)"), n).cast("double")


# ------------------------------------------------------------------- MA5

def available_items(tour: DataFrame, tour_group: DataFrame, slots: DataFrame, catalogue: DataFrame,
                    vendor_tour: DataFrame, vendor_detail: DataFrame, as_of: str) -> DataFrame:
    """Tours that can be booked since the day before ``as_of``, with their
    group and first vendor.  Group and vendor hang on the tour that was found,
    so an available id without a tour row has neither."""
    since = F.date_sub(F.to_date(F.lit(as_of)), 1)
    ids = (slots.where((F.to_date("inventory_date") >= since) & (F.col("closed") == F.lit(False))
                       & F.col("price_profile_id").isNotNull())
           .select("tour_id").distinct()
           .join(catalogue.where(F.col("status") == "ACTIVE").select(F.col("id").alias("tour_id")), "tour_id", "left_semi"))
    vendor = first_by_priority(vendor_tour, ["tour_id"], ["priority"],
                               payload=["vendor_detail_id", "is_inventory_automated", "fulfillment_type"])
    vendor = vendor.select(F.col("tour_id").alias("found_id"), "vendor_detail_id", "fulfillment_type",
                           F.when(F.col("is_inventory_automated") == F.lit(False), F.lit("No"))
                            .otherwise(F.lit("Yes")).alias("inventory_automated"))
    vd = vendor_detail.select(F.col("id").alias("vendor_detail_id"), F.col("name").alias("vendor_name"))
    t = tour.select(F.col("id").alias("tour_id"), F.col("id").alias("found_id"), F.col("name").alias("tour_name"),
                    F.col("tour_group_id").alias("group_id"))
    g = tour_group.select(F.col("id").alias("group_id"), F.col("id").alias("tour_group_id"), F.col("name").alias("product_name"), "city")
    return (ids.join(t, "tour_id", "left").join(g, "group_id", "left")
               .join(vendor, "found_id", "left").join(vd, "vendor_detail_id", "left")
               .select("tour_id", "tour_group_id", "tour_name", "product_name", "inventory_automated",
                       "fulfillment_type", "vendor_name", "city"))


# ------------------------------------------------------------------- MA6

def snapshot_pair(snap: DataFrame, run_id: str, pos: str = "row_no") -> DataFrame:
    """Current run beside the previous run (greatest run_id below it), looked
    up by tour id; of several previous rows the first by ``pos`` counts."""
    cur = snap.where(F.col("run_id") == run_id).select("tour_id", F.col("slots").alias("current_slots"))
    prev_run = snap.where(F.col("run_id") < run_id).agg(F.max("run_id")).scalar()
    prev = first_match_lookup(snap.where(F.col("run_id") == prev_run), "tour_id", pos, ["slots", "run_id"])
    prev = prev.select("tour_id", F.col("slots").alias("previous_slots"), F.col("run_id").alias("previous_run_id"))
    return cur.join(prev, "tour_id", "left")


def inventory_change(snap: DataFrame, run_id: str, bands=DROP_BANDS) -> DataFrame:
    p = snapshot_pair(snap, run_id)
    i = F.col("current_slots").try_cast("bigint")
    j = F.col("previous_slots").try_cast("bigint")
    return p.select("tour_id", i.alias("current"), j.alias("previous"), (i - j).alias("change"),
                    banded_flag(i, i - j, bands).alias("drop_flag"))


def top_increases(change: DataFrame, k: int = 12) -> DataFrame:
    """Report 1: change > 1, largest first, ``k`` rows (total order)."""
    return change.where(F.col("change") > 1).orderBy(F.col("change").desc(), F.col("tour_id")).limit(k)


def flagged_drops(change: DataFrame) -> DataFrame:
    """Report 2: flagged rows with a change, smallest change first."""
    return change.where((F.col("drop_flag") == "Yes") & F.col("change").isNotNull()) \
                 .orderBy(F.col("change"), F.col("tour_id"))


# ------------------------------------------------------------------- MA7

@dataclass(frozen=True)
class AlertParams:
    as_of: str
    hour: int
    lookback_days: int = 28
    weekdays: int = 4
    direction: str = "up"        # or "both"
    mode: str = "hour"           # or "cumulative": all hours up to ``hour``
    earliest_hour: int = 0
    not_contains: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()
    ignore_paused: bool = True
    active_days: int = 30

    def validate(self) -> None:
        if not (0 <= self.hour <= 23 and 0 <= self.earliest_hour <= 23):
            raise ValueError("hours must be within 0..23")
        if self.lookback_days < 1 or self.weekdays < 1:
            raise ValueError("lookback must be at least one day")
        if self.direction not in ("up", "both") or self.mode not in ("hour", "cumulative"):
            raise ValueError("unknown direction or mode")


def alert_thresholds(config: DataFrame) -> DataFrame:
    """JO14: (account, pct, min_abs, contact) from a config sheet of texts
    (account, pct, abs, contact, pos); an account's last row counts.  Accounts
    whose thresholds are no positive numbers are left out: they get no alerts."""
    last = last_match_lookup(config, "account", "pos", ["pct", "abs", "contact"])
    rows = last.select("account", F.col("pct").try_cast("double").alias("pct"), F.col("abs").try_cast("double").alias("min_abs"), "contact")
    return rows.where((F.col("pct") > 0) & (F.col("min_abs") > 0))


def alert_campaigns(cost: DataFrame, p: AlertParams) -> DataFrame:
    """FI7: ids of campaigns seen in the days before ``as_of`` whose status and
    name pass the filters."""
    asof = F.to_date(F.lit(p.as_of))
    recent = cost.where(F.to_date("ts").between(F.date_sub(asof, p.active_days), F.date_sub(asof, 1)))
    statuses = ["ENABLED"] if p.ignore_paused else ["ENABLED", "PAUSED"]
    return name_filter(recent, "name", p.not_contains, p.contains, "status", statuses, "campaign_id")


def require_campaigns(ids: DataFrame) -> DataFrame:
    """The action outside the plan: an error if the filters leave nothing."""
    if ids.isEmpty():
        raise ValueError("No campaigns found with the given settings.")
    return ids


def overspending(totals: DataFrame, thresholds: DataFrame, p: AlertParams) -> DataFrame:
    """FI14 on (account, ..., today, history): the absolute minimum first, then
    the relative change.  No history means an infinite change."""
    g = totals.join(thresholds, "account").withColumn("average", F.col("history") / float(p.weekdays))
    g = g.withColumn("difference", F.col("today") - F.col("average"))
    g = g.withColumn("pct_change", F.when(F.col("average") == 0, F.lit(float("inf"))).otherwise(F.col("difference") / F.col("average") * 100.0))
    big = F.col("difference") >= F.col("min_abs") if p.direction == "up" else F.abs("difference") >= F.col("min_abs")
    return g.where(big & (F.abs("pct_change") > F.col("pct")))


def spend_alert(cost: DataFrame, config: DataFrame, p: AlertParams) -> DataFrame:
    """cost: account, campaign_id, name, status, ts, cost, amount (budget).
    Spend of the current date against the average of the same weekdays in the
    lookback, at the same hour, for enabled rows of the chosen campaigns;
    thresholds come from the account's config row.  The budget is the current
    date's only.  Before ``earliest_hour`` nothing alerts."""
    p.validate()
    asof = F.to_date(F.lit(p.as_of))
    d = F.to_date("ts")
    at_hour = F.hour("ts") == p.hour if p.mode == "hour" else F.hour("ts") <= p.hour
    rows = (cost.where((F.col("status") == "ENABLED") & at_hour & d.between(F.date_sub(asof, p.lookback_days), asof)
                       & F.lit(p.hour >= p.earliest_hour))
            .join(alert_campaigns(cost, p), "campaign_id", "left_semi"))
    money = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c).cast("decimal(18,2)"))).cast("double"), F.lit(0.0))
    g = rows.groupBy("account", "campaign_id").agg(
        F.max("name").alias("name"), money("cost", d == asof).alias("today"), money("amount", d == asof).alias("budget"),
        money("cost", (d != asof) & (F.dayofweek(d) == F.dayofweek(asof))).alias("history"))
    return overspending(g, alert_thresholds(config), p).select(
        "account", "contact", "campaign_id", "name", F.lit(p.hour).alias("hour"), "today", "budget", "average", "difference", "pct_change", "pct")


# The message texts, numbers with two decimals.
ALERT_HEAD = "The following campaigns have exceeded the %s%% spend threshold:\n\n"
ALERT_ITEM = ("%d. \nName: %s\nChange(%%): %s\nChange(abs): %s\nHour: %d\n"
              "Daily Budget ($): %s\nSpend ($): %s\n\n")
MESSAGE_CAMPAIGNS = 200  # an account with more gets further messages


def alert_messages(alerts: DataFrame) -> DataFrame:
    """SK10: (account, part, subject, body): one body for an account, its
    campaigns numbered by id (delivery is out of scope)."""
    two = lambda c: F.when(F.abs(c) == float("inf"), F.lit("Infinity")).otherwise(F.format_string("%.2f", _round_half_up(c, 2)))
    no = positions(alerts, ["account"], "campaign_id").withColumn("part", F.floor(F.col("pos") / MESSAGE_CAMPAIGNS).cast("bigint"))
    item = F.format_string(ALERT_ITEM, (F.col("pos") + 1).cast("int"), F.col("name"), two(F.col("pct_change")), two(F.col("difference")),
                           F.col("hour"), two(F.col("budget")), two(F.col("today")))
    g = no.groupBy("account", "part").agg(
        F.max("contact").alias("contact"), F.max("pct").alias("pct"), F.sort_array(F.collect_list(F.struct("pos", item.alias("text")))).alias("items"))
    body = F.concat(F.lit("@"), F.col("contact"), F.lit("\n"), F.format_string(ALERT_HEAD, two(F.col("pct"))),
                    F.array_join(F.transform("items", lambda x: x["text"]), ""))
    return g.select("account", "part", F.concat("account", F.lit(" Campaigns exceeded threshold.")).alias("subject"), body.alias("body"))


# ------------------------------------------------------------------- MA9

def unique_requests(keywords: DataFrame, text: str = "text") -> DataFrame:
    """AG8: one estimate request for each distinct keyword text; its id is the
    smallest of the keyword rows, and it is negative if any of them is."""
    return keywords.groupBy(text).agg(F.min("request_id").alias("request_id"), F.max(F.coalesce("is_negative", F.lit(False))).alias("is_negative"))


def _mean2(lo: Column, hi: Column) -> Column:
    """The exact mean of both, rounded once to 2 places (half to even); NULL
    only when an estimate is NULL (0 stays 0)."""
    s = lo.cast("decimal(28,10)") + hi.cast("decimal(28,10)")
    return F.bround(s * F.lit(0.5).cast("decimal(2,1)"), 2).cast("double")


def estimate_mean(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Join requests and responses by request id (no positional zip), drop
    negative requests, mean of min/max estimates."""
    j = requests.where(~F.coalesce(F.col("is_negative"), F.lit(False))).join(responses, "request_id", "inner")
    return j.select("request_id", "text", _mean2(F.col("clicks_min"), F.col("clicks_max")).alias("clicks_mean"),
                    _mean2(F.col("impr_min"), F.col("impr_max")).alias("impressions_mean"))


# ------------------------------------------------------------------ MA10

def trends_long(counts: DataFrame, geo: str, keyword: str, value: str, size: int = 3) -> DataFrame:
    """Scores of keywords fetched in batches of ``size`` (by name): every geo
    has a score for every keyword of a batch, NULL where it has no value,
    scaled 0..100 by the batch's greatest value (scores are only comparable
    inside a batch).

    A batch is a table of ``size`` fixed slots for each geo, as it comes from
    the service; the slots are then turned into rows.  Neither the number of
    keywords nor of batches shapes the plan."""
    counts = materialise(counts.select(geo, keyword, value), "trend-counts")  # read three times below
    ranked = global_rank(counts.where(F.col(keyword).isNotNull()).select(keyword).distinct(), keyword, "_no")
    batch = materialise(ranked.select(F.col(keyword), F.floor(F.col("_no") / size).cast("bigint").alias("batch_id"), (F.col("_no") % size).cast("int").alias("_slot")), "trend-batches")
    slots = range(size)
    names = batch.groupBy("batch_id").agg(*[F.max(F.when(F.col("_slot") == i, F.col(keyword))).alias(f"_k{i}") for i in slots])
    last = names.agg(F.max("batch_id")).scalar()
    frame = counts.select(geo).distinct().withColumn("batch_id", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    wide = counts.join(batch, keyword).groupBy("batch_id", geo).agg(
        *[F.sum(F.when(F.col("_slot") == i, F.col(value))).alias(f"_v{i}") for i in slots])
    filled = frame.join(wide, ["batch_id", geo], "left").join(names, "batch_id")
    long = filled.select("batch_id", geo, F.explode(F.array(*[F.struct(F.col(f"_k{i}").alias(keyword), F.col(f"_v{i}").alias("raw")) for i in slots])).alias("_x"))
    long = long.select("batch_id", geo, f"_x.{keyword}", "_x.raw").where(F.col(keyword).isNotNull())
    top = long.groupBy("batch_id").agg(F.max("raw").alias("_max"))
    return long.join(top, "batch_id").select(
        "batch_id", geo, keyword, "raw", F.when(F.col("_max") > 0, F.expr("(100 * raw) div _max")).alias("score"))
