"""Core models: daily/monthly grains and latest-state entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.functions import surrogate_key
from histmart.operators import (
    SPREAD, first_by_value, flatten, last_of_day, latest_per_key, left_enrich_latest, previous_in_array,
)
from histmart.plans.stg import ORDERS, PRODUCT_ATTRS, desc


def _date_text(c="date"):
    return F.col(c).cast("string")


def core_price_daily(points: DataFrame) -> DataFrame:
    """Last price per (asin, channel, day): newest load, then latest time.

    ``points`` are the staged points or those of every load: the day's first
    row under (load, time, price, flag) is the same, since it has the day's
    newest load and so wins its own minute too. Day models over points of
    every load need one shuffle instead of two, and none where they are dealt by
    product (``_spread``, a function of product and day).
    """
    dealt = [SPREAD] if SPREAD in points.columns else []
    d = last_of_day(points.select("asin", *dealt, "price_channel", "snapshot_ts", "price", "was_sentinel", "ingest_ts"),
                    ["asin", *dealt, "price_channel"], "snapshot_ts", tie_break=[("price", "desc"), ("was_sentinel", "desc")])
    return d.select(surrogate_key("asin", "price_channel", _date_text()).alias("pk"),
                    "asin", "price_channel", "date", "price", "ingest_ts")


def core_rank_daily(points: DataFrame) -> DataFrame:
    d = last_of_day(points.select("asin", "snapshot_ts", "rank", "ingest_ts"), ["asin"], "snapshot_ts",
                    tie_break=[("rank", "desc")])
    return d.select(surrogate_key("asin", _date_text()).alias("pk"), "asin", "date", "rank", "ingest_ts")


def core_reviews_daily(stg_reviews: DataFrame) -> DataFrame:
    d = last_of_day(stg_reviews.select("asin", "snapshot_ts", "rating", "review_count", "ingest_ts"),
                    ["asin"], "snapshot_ts")
    return d.select(surrogate_key("asin", _date_text()).alias("pk"), "asin", "date", "rating",
                    "review_count", "ingest_ts")


def core_offer_price_daily(points: DataFrame) -> DataFrame:
    d = last_of_day(points.select("asin", "offer_id", "snapshot_ts", "price", "ingest_ts"),
                    ["asin", "offer_id"], "snapshot_ts", tie_break=[("price", "desc")])
    return d.select(surrogate_key("asin", "offer_id", _date_text()).alias("pk"), "asin", "offer_id",
                    "date", "price", "ingest_ts")


def core_buybox_daily(stg_buybox: DataFrame) -> DataFrame:
    """One seller per (asin, day): the alphabetically first (reference rule)."""
    b = stg_buybox.select("asin", F.col("snapshot_ts").cast("date").alias("date"), "seller_id")
    return first_by_value(b, ["asin", "date"], ["seller_id"]).select("asin", "date", "seller_id")


META_COLS = ("seller_id", "is_prime", "is_map", "condition_code", "shipping_dollars")


def core_offer_enriched(stg_offer_price: DataFrame, stg_offer_metadata: DataFrame, hidden: bool = False) -> DataFrame:
    """Offer price points with the newest metadata of their offer. ``hidden`` keeps the point's time for merges."""
    price = stg_offer_price.select("asin", "offer_id", F.col("snapshot_ts").cast("date").alias("date"), "price",
                                   *([F.col("snapshot_ts").alias("_o_snapshot_ts")] if hidden else []))
    out = left_enrich_latest(price, stg_offer_metadata, ["asin", "offer_id"], [("ingest_ts", "desc")],
                             tie_break=[("stg_offer_meta_id", "desc")], dim_cols=META_COLS)
    return out.select("asin", "offer_id", "date", "price", *META_COLS, *(["_o_snapshot_ts"] if hidden else []))


def core_offer_meta_latest(stg_offer_metadata: DataFrame) -> DataFrame:
    """The newest metadata of each offer."""
    return latest_per_key(stg_offer_metadata, ["asin", "offer_id"], desc(META_ORDER)).select(
        "asin", "offer_id", *META_COLS, "stg_offer_meta_id", "ingest_ts")


# Its total order: the newest load, and within a load the one of the staged table.
META_ORDER = ("ingest_ts", *ORDERS["stg_offer_metadata"])


def core_category_hierarchy(stg_category_tree: DataFrame) -> DataFrame:
    d = latest_per_key(stg_category_tree, ["asin", "category_id"], [("ingest_ts", "desc")],
                       tie_break=[("parent_category_id", "desc"), ("category_name", "desc"),
                                  ("category_level", "desc")])
    return d.select("asin", "category_id", "parent_category_id", "category_level", "category_name")


LATEST_COLS = ("brand", "binding", "color", "website_display_group", "website_display_group_name",
               "category_tree_v")


PRODUCT_ORDER = ("_o_ingest_ts", "_o_extracted_at", "_o_raw_id")


def core_product_latest(base: DataFrame, hidden: bool = False) -> DataFrame:
    """Newest snapshot per product. ``hidden`` keeps the order columns for merges."""
    src = base.select("asin", *LATEST_COLS, F.col("ingest_ts").alias("_o_ingest_ts"),
                      F.col("_airbyte_extracted_at").alias("_o_extracted_at"), F.col("_airbyte_raw_id").alias("_o_raw_id"))
    d = latest_per_key(src, ["asin"], [(c, "desc") for c in PRODUCT_ORDER])
    return d.select("asin", *LATEST_COLS, *(PRODUCT_ORDER if hidden else ()))


def core_product_categories(product_latest: DataFrame) -> DataFrame:
    """Ordered category path of each product, parent = previous element (row-local lag)."""
    p = product_latest.select("asin", previous_in_array(F.col("category_tree_v")).alias("_p"))
    e = flatten(p, "_p", keep=["asin"], outer=True, index="position", value="e")
    cur, prev = F.col("e.item"), F.col("e.previous")
    return e.select("asin", F.coalesce(cur["catId"], cur["id"]).alias("category_id"),
                    cur["name"].alias("category_name"),
                    F.coalesce(prev["catId"], prev["id"]).alias("parent_category_id"))


def core_product_enriched(stg_product_metadata: DataFrame) -> DataFrame:
    d = latest_per_key(stg_product_metadata, ["asin"], [("ingest_ts", "desc")],
                       tie_break=[("stg_product_meta_id", "desc")])
    return d.select("asin", *PRODUCT_ATTRS)


def core_sales_estimate_monthly(stg_sales: DataFrame) -> DataFrame:
    d = latest_per_key(stg_sales, ["asin", "sales_month"], [("ingest_ts", "desc")],
                       tie_break=[("est_units_sold", "desc")])
    return d.select("asin", "sales_month", "est_units_sold")
