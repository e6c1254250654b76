"""MA2: campaign -> up to three products, with sales-weighted divisors.

Inputs:

* ``api``: params STRUCT<report_date STRING>, payload ARRAY<STRUCT<campaigns
  ARRAY<STRUCT<campaignid BIGINT, creative STRUCT<asins ARRAY<STRING>>>>>>
* ``ad_groups``: list of (campaign_id, campaign_name, report_date) sources
* ``product_master``: child_asin, brand, last_updated_date
* ``pnl``: purchased_date_utc, asin, item_price_usd
* ``bulk``: campaign_id, creative_asins1..3

Plan notes: the name match is the substring join of ``operators.textjoin``, which
looks many product ids up whole; names, slots and chosen slots are written, and
what was shuffled for each leaves the disks before the next; the three per-slot
sales lookups are one join of the unpivoted slots with daily sales, folded back by
a grouped ``max(when)`` (one shuffle instead of three); every "one row per key"
step is a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.core import money_sum
from adlake.operators.relational import first_by_priority, latest_per_key, nth_rows_to_columns, pick_per_key
from adlake.operators.textjoin import contains_join
from adlake.session import settle

SLOTS = ("creative_asin1", "creative_asin2", "creative_asin3")
KEY = ["report_date", "campaign_id"]


def api_rows(api: DataFrame) -> DataFrame:
    """Two-level unnest; slots are the first three asins (1-based safe
    ordinals); one row per (campaign, date)."""
    p = api.select(F.to_date("params.report_date").alias("report_date"), F.explode("payload").alias("p"))
    c = p.select("report_date", F.explode("p.campaigns").alias("c"))
    rows = c.select("report_date", F.col("c.campaignid").alias("campaign_id"),
                    *[F.get("c.creative.asins", i).alias(s) for i, s in enumerate(SLOTS)])
    picked = pick_per_key(rows, KEY, list(SLOTS), latest=False, payload=[])
    return picked.withColumn("data_source_priority", F.lit(2))


def name_rows(ad_groups: list[DataFrame], product_master: DataFrame) -> DataFrame:
    camp = None
    for g in ad_groups:
        g = g.select("campaign_id", "campaign_name", "report_date")
        camp = g if camp is None else camp.unionByName(g)
    camp = settle(pick_per_key(camp, ["campaign_id", "report_date"], ["campaign_name"], latest=False, payload=[]), "campaign-names")  # read three times by the join
    asins = latest_per_key(product_master, ["child_asin"], "last_updated_date", payload=["brand"]) \
        .select(F.col("child_asin").alias("asin"))
    matched = contains_join(camp, "campaign_name", asins, "asin")
    slots = settle(nth_rows_to_columns(matched, KEY, ["asin"], "asin", 3, prefix="_slot"), "name-slots")
    return slots.select(*KEY, *[F.col(f"_slot{i + 1}").alias(s) for i, s in enumerate(SLOTS)],
                        F.when(F.col("_slot1").isNull(), F.lit(3)).otherwise(F.lit(1)).alias("data_source_priority"))


def daily_sales(pnl: DataFrame) -> DataFrame:
    return (pnl.groupBy(F.col("purchased_date_utc").alias("sales_date"), "asin")
            .agg(money_sum(F.coalesce("item_price_usd", F.lit(0.0))).alias("sales")))


def sales_divisors(api: DataFrame, ad_groups: list[DataFrame], product_master: DataFrame,
                   pnl: DataFrame, bulk: DataFrame) -> DataFrame:
    both = api_rows(api).unionByName(name_rows(ad_groups, product_master))
    chosen = first_by_priority(both, KEY, ["data_source_priority"], payload=list(SLOTS))
    b = bulk.groupBy("campaign_id").agg(*[F.min(f"creative_asins{i + 1}").alias(f"_b{i + 1}") for i in range(3)])
    ads = settle(chosen.join(b, "campaign_id", "left").select(
        *KEY, *[F.coalesce(s, f"_b{i + 1}").alias(s) for i, s in enumerate(SLOTS)]), "divisor-slots")  # read twice below

    # slot sales: unpivot -> one join -> fold back
    long = ads.select(*KEY, F.explode(F.array(*[F.struct(F.lit(i + 1).alias("k"), F.col(s).alias("asin"))
                                                for i, s in enumerate(SLOTS)])).alias("x")) \
              .select(*KEY, "x.k", "x.asin")
    ds = daily_sales(pnl)
    sold = long.join(ds, (long["asin"] == ds["asin"]) & (long["report_date"] == ds["sales_date"]), "left") \
               .select(*[long[c] for c in KEY], long["k"], F.coalesce(ds["sales"], F.lit(0.0)).alias("s"))
    s = sold.groupBy(*KEY).agg(*[F.max(F.when(F.col("k") == i + 1, F.col("s"))).alias(f"s{i + 1}") for i in range(3)])
    d = ads.join(s, KEY, "left")
    tot = F.col("s1") + F.col("s2") + F.col("s3")
    d = d.select(*KEY, *SLOTS, *[F.try_divide(F.col(f"s{i + 1}"), tot).alias(f"d{i + 1}") for i in range(3)])

    a1, a2, a3 = (F.col(s) for s in SLOTS)
    d1, d2, d3 = F.col("d1"), F.col("d2"), F.col("d3")
    three = ~(a1.isNull() | a2.isNull() | a3.isNull()) & d1.isNull() & d2.isNull() & d3.isNull()
    two = ~(a1.isNull() | a2.isNull()) & d1.isNull() & d2.isNull()
    one = a1.isNotNull() & a2.isNull() & a3.isNull() & d1.isNull()

    def divisor(n: int):
        e = F.when(three, F.lit(1.0 / 3))
        if n != 3:
            e = e.when(two, F.lit(0.5))
        if n == 1:
            e = e.when(one, F.lit(1.0))
        return e.otherwise(F.coalesce(F.col(f"d{n}"), F.lit(0.0)))

    return d.where(a1.isNotNull()).select(*KEY, *SLOTS, *[divisor(n).alias(f"divisor_{n}") for n in (1, 2, 3)])
