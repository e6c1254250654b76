"""MA4: ads summary — search terms with monthly totals, evenly allocated
daily traffic, renamed campaigns and monthly product traffic per row.

Inputs (see FIXTURES.md): ``search_terms``, ``sales_traffic``,
``campaign_map``, ``asin_traffic``.  The per-key tables beside the facts (monthly
totals, daily traffic, mappings, products) are partial aggregates, evaluated
once and written; the planner then knows their sizes, and as long as they are
under the broadcast threshold the facts are joined where they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.session import materialise

TRAFFIC = ("Ordered_Product_Sales", "sessions_total", "Units_Ordered", "Total_Order_Items",
           "Units_Refunded", "Feedback_Received")
ADJUSTED = ("ordered_product_sales_adjusted", "sessions_adjusted", "units_ordered_adjusted",
            "total_order_items_adjusted", "units_refunded_adjusted", "feedback_received_adjusted")
ASIN_T = (("sessions_total", "sessions", "monthly_sessions"), ("page_views_total", "page_views", "monthly_pageviews"),
          ("units_ordered", "units_ordered", "monthly_units_ordered"),
          ("ordered_product_sales", "ordered_product_sales", "monthly_ordered_product_sales"),
          ("total_order_items", "total_order_items", "monthly_total_units_ordered"))


def _exact_decimal(c: str):
    return F.sum(F.col(c).cast("decimal(22,4)")).cast("decimal(28,4)").alias(c)


def round2(c):
    return F.round(c.cast("decimal(38,10)"), 2).cast("double")


def ads_summary(search_terms: DataFrame, sales_traffic: DataFrame, campaign_map: DataFrame,
                asin_traffic: DataFrame) -> DataFrame:
    """Beside its rows the fact table gives three small aggregates: one by
    (term, targeting, month) that all monthly totals come from, row counts by
    day, and row counts by (campaign, ad group, month), which, carried through
    the mappings, are the rows of a product type."""
    facts = search_terms.withColumn("month", F.month("Date")).withColumn("year", F.year("Date"))
    sums = [_exact_decimal("spend"), F.sum("Clicks").alias("Clicks"), _exact_decimal("_14_Day_Total_Sales")]
    base = materialise(facts.groupBy("Customer_Search_Term", "Targeting", "month", "year").agg(*sums), "ads-months")

    def monthly(key: str, stem: str) -> DataFrame:
        g = base.where(F.col(key).isNotNull()).groupBy(key, "month", "year").agg(*sums)
        return g.select(key, "month", "year", F.col("spend").cast("double").alias(f"{stem}_monthly_spend"), F.col("Clicks").alias(f"{stem}_monthly_clicks"),
                        F.col("_14_Day_Total_Sales").cast("double").alias(f"{stem}_monthly_sales"))

    per_day = facts.groupBy("Date").agg(F.count("*").alias("_rows"))
    daily = materialise(sales_traffic.join(per_day, "Date", "left").select(
        "Date", *TRAFFIC, *[(F.col(t) / F.col("_rows")).alias(a) for t, a in zip(TRAFFIC, ADJUSTED)]), "ads-days")
    campaigns = materialise(campaign_map.select(F.col("campaign").alias("campaign_name"), "campaign_new").distinct(), "ads-campaigns")
    groups = materialise(campaign_map.select(F.col("ad_group").alias("ad_group_name"), "ad_group_new", "product_type").distinct(), "ads-groups")

    def mapped(rows: DataFrame) -> DataFrame:  # a name with two new names makes two rows
        return rows.join(campaigns, "campaign_name", "left").join(groups, "ad_group_name", "left")

    per_type = mapped(facts.groupBy("campaign_name", "ad_group_name", "month", "year").agg(F.count("*").alias("rows")))
    per_type = per_type.where("product_type is not null").groupBy("year", "month", "product_type").agg(F.sum("rows").alias("divisor"))
    products = (asin_traffic.groupBy(F.year("Date").alias("year"), F.month("Date").alias("month"), "product_type")
                .agg(*[(_exact_decimal(c).cast("double") if c == "ordered_product_sales" else F.sum(c)).alias(f"_{c}") for c, _, _ in ASIN_T]))
    products = materialise(products.join(per_type, ["year", "month", "product_type"], "left").select(
        "year", "month", "product_type", *[round2(F.col(f"_{c}") / F.col("divisor")).alias(out) for c, _, out in ASIN_T]), "ads-products")

    rows = (mapped(facts).join(monthly("Customer_Search_Term", "st"), ["Customer_Search_Term", "month", "year"], "left")
            .join(monthly("Targeting", "kw"), ["Targeting", "month", "year"], "left").join(daily, "Date", "left")
            .join(products, ["year", "month", "product_type"], "left"))
    kept = [c for c in search_terms.columns if c not in ("campaign_name", "ad_group_name")]
    return rows.select(
        *kept, F.coalesce("campaign_new", "campaign_name").alias("campaign_name"),
        F.coalesce("ad_group_new", "ad_group_name").alias("ad_group_name"), "product_type",
        *[f"{stem}_monthly_{m}" for stem in ("st", "kw") for m in ("spend", "clicks", "sales")],
        *TRAFFIC, *ADJUSTED, *[out for _, _, out in ASIN_T])
