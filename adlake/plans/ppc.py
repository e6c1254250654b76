"""MA1: weekly ad incrementality and margin mart.

Inputs (one DataFrame each):

* six ad-fact arms (keyword arms carry ``keyword_text``, ``match_type``,
  ``h10_rank``; target arms carry ``targeting_text``), see ``ARMS``;
* ``products``: asin, title, brand, amazon_domain, scrap_rank, bsr_tree_rank;
* ``volume``: year, week, phrase, search_volume;
* ``status_daily``: update_date, child_asin, product_status, inventory_status.

Plan shape: union of arms (filter pushed into every arm) -> inner join with
the domain-filtered products (the source's left join plus ``brand IS NOT
NULL`` is an inner join) -> left join volume on (phrase, week, year) -> left
join latest weekly status on (asin, year, week) -> one projection.  The
weekly status pick is a partial ``max(struct)`` aggregate, so a product that
dominates the status feed is reduced before its shuffle.  The volume is
evaluated first: while it is small (phrases times weeks), the ad rows meet it
where they are and aren't shuffled by phrase.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.core import (contains_text, greatest_strict, is_true, safe_divide,
                                   sunday_week, truncate_upper)
from adlake.operators.relational import latest_per_key
from adlake.session import materialise

# Fixed values (must equal the source model):
# ad arms in union order: (ad_type, target_type)
ARMS = (
    ("Sponsored Product", "Keyword"),
    ("Sponsored Product", "Target"),
    ("Sponsored Display", "Target"),
    ("Sponsored Brand", "Keyword"),
    ("Sponsored Brand", "Target"),
    ("Sponsored Brand Video", "Keyword"),
)
FEES = ("fba_fees", "cogs", "promo", "refunded", "google_cost", "dsp_cost")
# ratio column stem per fee (google_cost -> google_perc, dsp_cost -> dsp_perc)
FEE_STEM = {"fba_fees": "fba_fees", "cogs": "cogs", "promo": "promo", "refunded": "refunded",
            "google_cost": "google", "dsp_cost": "dsp"}


@dataclass(frozen=True)
class PpcParams:
    # Incrementality factor by rank, branded search terms
    branded_lt_5: float = 0.1
    branded_lt_15: float = 0.25
    branded_lt_41: float = 0.5
    branded_default: float = 0.75
    # non-branded search terms, rank below 5
    non_branded_lt_5: float = 0.2
    # contribution margin by product / inventory status
    status_deplete_liquidate: float = 0.3
    status_overstock: float = 0.34
    status_new: float = 1.0
    domain: str = "amazon.com"
    brand_match: str = "contains"   # or "like" (wildcard-faithful, S6)


def arm(df: DataFrame, ad_type: str, target_type: str, first: bool = False) -> DataFrame:
    """Normalise one ad-fact source to the union schema."""
    kw = target_type == "Keyword"
    return df.select(
        "week", "year", "week_start", "week_end", "branded_asin",
        F.lit(ad_type).alias("ad_type"),
        F.lit(target_type).alias("target_type"),
        F.col("keyword_text" if kw else "targeting_text").alias("keyword_or_target"),
        (F.col("match_type") if kw else F.lit("")).alias("match_type"),
        (F.col("query") if first else F.lit("")).alias("query"),
        "cost", "impressions", "clicks", "orders", "sales", "ctr", "cpc", "acos",
        (F.col("h10_rank") if kw else F.lit(None).cast("bigint")).alias("h10_rank"),
        *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in FEES],
        "ppc_incrementality_factor",
    )


def union_arms(arms: list[DataFrame]) -> DataFrame:
    if len(arms) != len(ARMS):
        raise ValueError(f"expected {len(ARMS)} arms")
    out = None
    for i, (df, (ad_type, tt)) in enumerate(zip(arms, ARMS)):
        a = arm(df, ad_type, tt, first=(i == 0))
        out = a if out is None else out.unionByName(a)
    return out


def weekly_status(status_daily: DataFrame) -> DataFrame:
    """Latest status row per (product, year, Sunday-week)."""
    s = status_daily.select(
        F.year("update_date").alias("year"), sunday_week("update_date").alias("week"),
        "child_asin", "update_date", "product_status", "inventory_status")
    return latest_per_key(s, ["child_asin", "year", "week"], "update_date",
                          payload=["product_status", "inventory_status"]).drop("update_date")


def ppc_mart(arms: list[DataFrame], products: DataFrame, volume: DataFrame,
             status_daily: DataFrame, p: PpcParams = PpcParams()) -> DataFrame:
    u = union_arms(arms)
    u = u.where((F.col("cost") + F.col("impressions") + F.col("clicks") + F.col("orders")
                 + F.col("sales")) > 0)
    prod = (products.where((F.col("scrap_rank") == 1) & (F.col("bsr_tree_rank") == 1)
                           & (F.lower("amazon_domain") == p.domain) & F.col("brand").isNotNull())
            .select(F.col("asin").alias("branded_asin"), truncate_upper("title").alias("title"),
                    F.col("brand").alias("p_brand")))
    vol = materialise(volume.select(F.col("phrase").alias("keyword_or_target"), "week", "year",
                                    F.col("search_volume").alias("keyword_search_volume")), "phrase-volume")
    st = weekly_status(status_daily).withColumnRenamed("child_asin", "branded_asin")

    j = (u.join(prod, "branded_asin", "inner")
          .join(vol, ["keyword_or_target", "week", "year"], "left")
          .join(st, ["branded_asin", "year", "week"], "left"))

    sales, promo, orders, cost = F.col("sales"), F.col("promo"), F.col("orders"), F.col("cost")
    net = sales - promo
    cm_true = (F.when(sales == 0, F.lit(0.0))
               .otherwise(safe_divide(sales - F.col("fba_fees") - F.col("cogs") - promo
                                      - F.col("refunded") - F.col("google_cost")
                                      - F.col("dsp_cost"), net)))
    brand_l = F.lower("p_brand")
    branded = (F.when(F.col("p_brand").isNull(), F.lit(False))
               .when(contains_text(F.lower("query"), brand_l, p.brand_match), F.lit(True))
               .when(contains_text(F.lower("keyword_or_target"), brand_l, p.brand_match)
                     & (F.col("target_type") == "Keyword"), F.lit(True))
               .otherwise(F.lit(False)))
    target_new = (F.when(F.col("target_type") == "Keyword", F.lit("Keyword"))
                  .when(F.col("keyword_or_target").contains("asin"), F.lit("Asin"))
                  .when(F.col("keyword_or_target").contains("category"), F.lit("Category"))
                  .otherwise(F.col("target_type")))

    base = j.select(
        "*",
        F.upper("p_brand").alias("brand"),
        target_new.alias("target_type_new"),
        *[safe_divide(F.col(f), net).alias(f"{FEE_STEM[f]}_perc") for f in FEES],
        *[safe_divide(F.col(f), orders).alias(f"{FEE_STEM[f]}_unit") for f in FEES],
        cm_true.alias("cm_perc_true"),
        branded.alias("branded_search"),
    )

    rank = F.col("h10_rank")
    factor = (F.when(is_true("branded_search"),
                     F.when(rank < 5, F.lit(p.branded_lt_5))
                      .when(rank < 15, F.lit(p.branded_lt_15))
                      .when(rank < 41, F.lit(p.branded_lt_41))
                      .otherwise(F.lit(p.branded_default)))
              .otherwise(F.when(rank < 5, F.lit(p.non_branded_lt_5))
                          .otherwise(F.col("ppc_incrementality_factor"))))
    inv, pst = F.lower("inventory_status"), F.lower("product_status")
    cm_fw = (F.when(inv.isin("liquidate", "deplete"),
                    F.lit(p.status_deplete_liquidate) + F.lit(0.5) * safe_divide("cogs", "sales"))
             .when(inv == "overstock", F.lit(p.status_overstock))
             .when(pst.isin("new"), F.lit(p.status_new))
             .otherwise(F.col("cm_perc_true")))
    base = base.withColumn("factor_new", factor).withColumn("cm_perc_framework", cm_fw)

    ct, cf, fac = F.col("cm_perc_true"), F.col("cm_perc_framework"), F.col("factor_new")
    best = greatest_strict(ct, cf)

    def ebitda(margin: Column, with_factor: bool) -> Column:
        gross = sales * margin
        if with_factor:
            gross = gross * fac
        return F.when(sales == 0, -cost).otherwise(gross - cost)

    return base.select(
        "week", "year", "week_start", "week_end", "branded_asin", "title", "brand",
        "product_status", "inventory_status", "ad_type",
        F.col("target_type_new").alias("target_type"),
        "keyword_or_target", "branded_search", "keyword_search_volume", "match_type", "query",
        "cost", "impressions", "clicks", "orders",
        net.alias("sales"),
        "ctr", "cpc", "acos", "h10_rank", *FEES,
        fac.alias("ppc_incrementality_factor"),
        *[f"{FEE_STEM[f]}_perc" for f in FEES],
        *[f"{FEE_STEM[f]}_unit" for f in FEES],
        "cm_perc_true", "cm_perc_framework",
        F.when(ct >= cf, F.lit("TRUE")).when(ct < cf, F.lit("FRAMEWORK")).alias("cm_applied"),
        ebitda(ct, False).alias("ebitda_true_cm"),
        ebitda(ct, True).alias("incremental_ebitda_true_cm"),
        ebitda(best, False).alias("ebitda_framework_cm"),
        ebitda(best, True).alias("incremental_ebitda_framework_cm"),
    )
