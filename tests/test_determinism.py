"""Metamorphic: the same feed in another row order and partitioning gives the same models."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from histmart.plans.feed import product_feed
from histmart.plans.models import build_models

MODELS = ["stg_price", "stg_offers", "stg_offer_metadata", "stg_product_metadata", "stg_reviews",
          "core_offer_enriched", "core_category_hierarchy", "dim_category", "dim_product",
          "fct_buybox_history_daily", "fct_sales_estimate_monthly", "quarantine_union"]


@pytest.fixture(scope="module")
def two_orders(spark):
    feed = product_feed(spark, SF_SMALL)
    shuffled = feed.withColumn("_r", F.rand(7)).repartition(5, "_r").sortWithinPartitions("_r").drop("_r")
    return build_models(feed), build_models(shuffled)


@pytest.mark.parametrize("name", MODELS)
def test_same_rows(two_orders, name):
    a, b = two_orders

    def rows(df):
        cols = sorted(df.columns)
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    assert rows(a[name]) == rows(b[name])
