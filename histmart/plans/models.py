"""The whole model graph as a table of functions, and the declared data tests."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.operators.quality import Check, DataTest, reason_column, suspects
from histmart.plans import bad, core, marts, stg


Graph = Mapping[str, DataFrame]

# Every model as a function of the graph that it is part of.
MODELS: dict[str, Callable[[Graph], DataFrame]] = {
    "stg_price": lambda m: stg.stg_price(m["stg_base"]),
    "stg_rank": lambda m: stg.stg_rank(m["stg_base"]),
    "stg_reviews": lambda m: stg.stg_reviews(m["stg_base"]),
    "stg_offers": lambda m: stg.stg_offers(m["stg_base"]),
    "stg_offer_metadata": lambda m: stg.stg_offer_metadata(m["stg_base"]),
    "stg_offer_price": lambda m: stg.stg_offer_price(stg.offer_snapshots(m["stg_base"])),
    "stg_buybox_history": lambda m: stg.stg_buybox_history(m["stg_base"]),
    "stg_category_tree": lambda m: stg.stg_category_tree(m["stg_base"]),
    "stg_product_metadata": lambda m: stg.stg_product_metadata(m["stg_base"]),
    "stg_sales_monthly_stats": lambda m: stg.stg_sales_monthly_stats(m["stg_base"]),
    "stg_videos": lambda m: stg.stg_videos(m["stg_base"]),
    "stg_aplus_module": lambda m: stg.stg_aplus_module(m["stg_base"]),

    "stg_price__bad": lambda m: bad.price_bad(m["stg_price"]),
    "stg_rank__bad": lambda m: bad.rank_bad(m["stg_rank"]),
    "stg_reviews__bad": lambda m: bad.reviews_bad(m["stg_reviews"]),
    "stg_offers__bad": lambda m: bad.offers_bad(m["stg_offers"]),
    "stg_aplus_module__bad": lambda m: bad.aplus_bad(m["stg_aplus_module"]),
    "stg_base__bad": lambda m: bad.base_bad(m["stg_base"]),
    "quarantine_union": lambda m: bad.quarantine_rollup(
        *[m[f"stg_{n}__bad"] for n in ("price", "rank", "reviews", "offers", "aplus_module")], base=m["stg_base__bad"]),

    "core_price_daily": lambda m: core.core_price_daily(stg.price_points(m["stg_base"])),
    "core_rank_daily": lambda m: core.core_rank_daily(stg.rank_points(m["stg_base"])),
    "core_reviews_daily": lambda m: core.core_reviews_daily(m["stg_reviews"]),
    "core_offer_price_daily": lambda m: core.core_offer_price_daily(stg.offer_price_points(stg.offer_snapshots(m["stg_base"]))),
    "core_buybox_daily": lambda m: core.core_buybox_daily(m["stg_buybox_history"]),
    "core_offer_enriched": lambda m: core.core_offer_enriched(m["stg_offer_price"], m["stg_offer_metadata"]),
    "core_category_hierarchy": lambda m: core.core_category_hierarchy(m["stg_category_tree"]),
    "core_product_latest": lambda m: core.core_product_latest(m["stg_base"]),
    "core_product_categories": lambda m: core.core_product_categories(m["core_product_latest"]),
    "core_product_enriched": lambda m: core.core_product_enriched(m["stg_product_metadata"]),
    "core_sales_estimate_monthly": lambda m: core.core_sales_estimate_monthly(m["stg_sales_monthly_stats"]),

    "dim_product": lambda m: marts.dim_product(m["core_product_latest"]),
    "dim_product_enriched": lambda m: marts.dim_product_enriched(m["core_product_enriched"]),
    "dim_category": lambda m: marts.dim_category(m["core_product_categories"]),
    "dim_product_category": lambda m: marts.dim_product_category(m["core_product_categories"]),
    "dim_seller": lambda m: marts.dim_seller(m["stg_offers"]),
    "fct_price_history_daily": lambda m: marts.fct_price_history_daily(m["core_price_daily"]),
    "fct_rank_history_daily": lambda m: marts.fct_rank_history_daily(m["core_rank_daily"]),
    "fct_review_history_daily": lambda m: marts.fct_review_history_daily(m["core_reviews_daily"]),
    "fct_offer_price_daily": lambda m: marts.fct_offer_price_daily(m["core_offer_price_daily"]),
    "fct_buybox_history_daily": lambda m: marts.fct_buybox_history_daily(m["core_buybox_daily"]),
    "fct_sales_estimate_monthly": lambda m: marts.fct_sales_estimate_monthly(m["core_sales_estimate_monthly"]),
}


class _Models(Mapping):
    """The graph over one base; a model's plan is built when it is first asked for, with those that it reads."""

    def __init__(self, base: DataFrame):
        self._built = {"stg_base": base}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name](self)
        return self._built[name]

    def __iter__(self):
        return iter(["stg_base", *MODELS])

    def __len__(self) -> int:
        return 1 + len(MODELS)


def build_models(raw: DataFrame | None, base: DataFrame | None = None) -> Graph:
    """All models, lazily, from RAW rows (``payload`` VARIANT + ``ingest_dt``) or a typed base."""
    return _Models(base if base is not None else stg.product_base(raw))


def quarantine_models(b: DataFrame) -> DataFrame:
    """The roll-up of all quarantines straight from the typed base.

    Points, of which every load brings many, are reduced to the keys of those that break a rule before they are shuffled.
    """
    def broken(rows, rules):
        return rows.filter(reason_column(rules).isNotNull())

    price, rank, (rating, count) = stg.plain_price_points(b), stg.rank_points(b), stg.review_pairs(b)
    price = suspects(price, ["asin", "price_channel", "snapshot_ts"], broken(price, bad.price_rules()))
    rank = suspects(rank, ["asin", "snapshot_ts"], broken(rank, bad.rank_rules()))
    both = stg.review_values(rating.withColumn("raw_count", F.lit(None).cast("bigint")).unionByName(
        count.withColumn("raw_rating", F.lit(None).cast("bigint"))), rating_type=None)
    doubtful = broken(both, bad.reviews_rules())
    sides = stg.newest_sides(*[suspects(x, ["asin", "series_min"], doubtful) for x in (rating, count)])
    offers = stg.offer_snapshots(b)
    offers = suspects(offers, ["asin", "offer_id"], broken(offers, bad.offers_rules()))
    return bad.quarantine_rollup(
        bad.price_bad(stg.price_of(price)), bad.rank_bad(stg.rank_of(rank)), bad.reviews_bad(stg.reviews_from_sides(*sides)),
        bad.offers_bad(stg.offers_of(offers)), bad.aplus_bad(stg.stg_aplus_module(b)), base=bad.base_bad(b))


def _row_tests() -> list[DataTest]:
    keyed = [("dim_product", "asin"), ("dim_category", "category_id"), ("dim_product_category", "pk"),
             *((f, "pk") for f in ("fct_price_history_daily", "fct_rank_history_daily", "fct_review_history_daily", "fct_offer_price_daily"))]
    return [DataTest(f"{model}__{column}__{kind}", model, kind, column) for model, column in keyed for kind in ("unique", "not_null")]


# The declared data tests of the staging and mart models.
TESTS: list[DataTest] = [
    # staging
    DataTest("stg_price__price__expression", "stg_price", "expression", arg="price is null or price >= 0"),
    DataTest("stg_rank__asin__not_null", "stg_rank", "not_null", "asin"),
    DataTest("stg_reviews__asin__not_null", "stg_reviews", "not_null", "asin"),
    DataTest("stg_reviews__rating__expression", "stg_reviews", "expression", arg="rating is null or (rating >= 0 and rating <= 5)"),
    DataTest("stg_reviews__review_count__expression", "stg_reviews", "expression", arg="review_count is null or review_count >= 0"),
    DataTest("stg_offers__stg_offer_id__not_null", "stg_offers", "not_null", "stg_offer_id"),
    DataTest("stg_offers__stg_offer_id__unique", "stg_offers", "unique", "stg_offer_id"),
    DataTest("stg_offer_price__asin__not_null", "stg_offer_price", "not_null", "asin"),
    DataTest("stg_offer_price__offer_id__not_null", "stg_offer_price", "not_null", "offer_id"),
    DataTest("stg_aplus_module__asin__not_null", "stg_aplus_module", "not_null", "asin"),
    DataTest("stg_aplus_module__asset_type__accepted_values", "stg_aplus_module", "accepted_values", "asset_type",
             ("image", "image_alt", "text", "video")),
    DataTest("stg_videos__asin__not_null", "stg_videos", "not_null", "asin"),
    DataTest("stg_videos__stg_video_id__unique", "stg_videos", "unique", "stg_video_id"),
    DataTest("stg_videos__stg_video_id__not_null", "stg_videos", "not_null", "stg_video_id"),
    # marts
    *_row_tests(),
    *(DataTest(f"{model}__asin__relationships", model, "relationships", "asin", ("dim_product", "asin"))
      for model in ("dim_product_category", "fct_price_history_daily", "fct_rank_history_daily", "fct_review_history_daily",
                    "fct_offer_price_daily")),
    DataTest("dim_product_category__category_id__relationships", "dim_product_category", "relationships", "category_id",
             ("dim_category", "category_id")),
    # singular
    DataTest("test_price_nonnegative", "stg_price", "failing", arg="price < 0"),
]


def model_checks(m: Graph) -> list[Check]:
    """The declared tests as frames of their failing rows."""
    return [Check(t.name, t.failures(m)) for t in TESTS]
