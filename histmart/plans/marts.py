"""Mart models: dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.functions import surrogate_key
from histmart.operators import first_by_value
from histmart.plans.stg import PRODUCT_ATTRS

DIM_PRODUCT_COLS = ("asin", "brand", "binding", "color", "website_display_group",
                    "website_display_group_name")


def dim_product(product_latest: DataFrame) -> DataFrame:
    return product_latest.select(*DIM_PRODUCT_COLS)


def dim_product_enriched(product_enriched: DataFrame) -> DataFrame:
    return product_enriched.select("asin", *PRODUCT_ATTRS)


def dim_category(product_categories: DataFrame) -> DataFrame:
    """One row per non-NULL category id (name, then parent, ascending)."""
    c = product_categories.filter(F.col("category_id").isNotNull()).select(
        "category_id", "category_name", "parent_category_id")
    return first_by_value(c, ["category_id"], ["category_name", "parent_category_id"])


def dim_product_category(product_categories: DataFrame) -> DataFrame:
    c = product_categories.filter(F.col("category_id").isNotNull())
    return c.select(surrogate_key("asin", "category_id").alias("pk"), "asin", "category_id")


def dim_seller(stg_offers: DataFrame) -> DataFrame:
    return stg_offers.filter(F.col("seller_id").isNotNull()).select("seller_id").distinct()


def fct_price_history_daily(price_daily: DataFrame) -> DataFrame:
    return price_daily.select(surrogate_key("asin", "price_channel", F.col("date").cast("string")).alias("pk"),
                              "asin", "price_channel", "date", "price")


def fct_rank_history_daily(rank_daily: DataFrame) -> DataFrame:
    return rank_daily.select(surrogate_key("asin", F.col("date").cast("string")).alias("pk"),
                             "asin", "date", "rank")


def fct_review_history_daily(reviews_daily: DataFrame) -> DataFrame:
    return reviews_daily.select(surrogate_key("asin", F.col("date").cast("string")).alias("pk"),
                                "asin", "date", "rating", "review_count")


def fct_offer_price_daily(offer_price_daily: DataFrame) -> DataFrame:
    src = offer_price_daily.filter(F.col("date").isNotNull())
    pk = surrogate_key(F.coalesce(F.col("asin"), F.lit("_UNKNOWN_ASIN_")),
                       F.coalesce(F.col("offer_id"), F.lit("_UNKNOWN_OFFER_")),
                       F.col("date").cast("string"))
    return src.select(pk.alias("pk"), "asin", "offer_id", "date", "price")


def fct_buybox_history_daily(buybox_daily: DataFrame) -> DataFrame:
    pk = surrogate_key("asin", F.col("date").cast("string"), F.coalesce(F.col("seller_id"), F.lit("NULL")))
    return buybox_daily.select(pk.alias("pk"), "asin", "date", "seller_id")


def fct_sales_estimate_monthly(sales_monthly: DataFrame) -> DataFrame:
    src = sales_monthly.filter(F.col("est_units_sold").isNotNull() & (F.col("est_units_sold") >= 0))
    pk = F.md5(F.concat(F.col("asin"), F.lit("|"), F.col("sales_month").cast("string"),
                        F.lit("|SALES_ESTIMATE_MONTHLY")))
    return src.select(pk.alias("pk"), "asin", "sales_month", "est_units_sold")
