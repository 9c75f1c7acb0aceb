"""Name -> query callable (spark, sf_dir) -> DataFrame, and name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.plans import standins as s
from histmart.plans import stg
from histmart.plans.feed import ndjson_feed, odd_feed, product_feed
from histmart.plans.feed_oracle import FINAL as FEED_MODELS, feed_oracles
from histmart.plans.models import build_models, quarantine_models
from histmart.plans.oracle import oracle_queries
from histmart.plans.stg import product_base
from histmart.session import shared_path
from histmart.streaming.incremental import stream_full_outer, table_stream

Query = Callable[[SparkSession, str], DataFrame]


def standin_queries() -> dict[str, Query]:
    return {
        "json_path_extract": s.json_path_extract,
        "variant_as_text": s.variant_as_text,
        "ndjson_round_trip": s.ndjson_round_trip,
        "ndjson_bad_lines": s.ndjson_bad_lines,
        "load_status": s.load_status_query,
        "flatten_inner": s.flatten_inner,
        "flatten_outer": s.flatten_outer,
        "flatten_nested_assets": s.flatten_nested_assets,
        "pair_decode_full": s.pair_decode_full,
        "pair_decode_strict": s.pair_decode_strict,
        "pair_decode_groupby": s.pair_decode_groupby,
        "channel_decode": s.channel_decode,
        "text_series_decode": s.text_series_decode,
        "minutes_to_ts": s.minutes_to_ts_query,
        "sentinel_to_null": s.sentinel_to_null_query,
        "price_band_filter": s.price_band_filter,
        "full_outer_series": s.full_outer_series_query,
        "left_enrich_latest": s.left_enrich_latest_query,
        "latest_per_key": s.latest_per_key_query,
        "last_of_day": s.last_of_day_query,
        "first_by_value_of_day": s.first_by_value_of_day,
        "lag_parent": s.lag_parent_query,
        "monthly_latest": s.monthly_latest,
        "dim_distinct": s.dim_distinct,
        "distinct_sellers": s.dim_seller_query,
        "bridge_product_category": s.bridge_product_category,
        "surrogate_key": s.surrogate_key_query,
        "fact_filtered": s.fact_filtered,
        "upsert_incremental": s.upsert_incremental,
        "append_boundary": s.append_boundary,
        "upsert_late_load": s.upsert_late_load,
        "upsert_null_keys": s.upsert_null_keys,
        "upsert_null_safe": s.upsert_null_safe,
        "full_refresh_replaces": s.full_refresh_replaces,
        "upsert_moved_partition": s.upsert_moved_partition,
        "strict_event_date": s.strict_event_date,
        "offset_self_join": s.offset_self_join_query,
        "lag_parent_hot": s.lag_parent_hot,
        "load_lineage": s.load_lineage,
        "json_array_load": s.json_array_load,
        "json_array_split": s.json_array_split,
        "stored_failures": s.stored_failures,
        "run_monitoring_row": s.run_monitoring_row,
        "view_materialised": s.view_materialised,
        "empty_text_filter": s.empty_text_filter,
        "quarantine_split": s.quarantine_split,
        "quarantine_good": s.quarantine_good,
        "quarantine_union": s.quarantine_union_query,
        "check_not_null": s.check_not_null,
        "check_unique": s.check_unique,
        "check_accepted_values": s.check_accepted_values,
        "check_relationships": s.check_relationships,
        "check_expression": s.check_expression,
        "run_metrics": s.run_metrics,
        "stream_last_of_day": s.stream_last_of_day_query,
        "stream_windowed_last_of_day": s.stream_windowed_last_of_day,
        "stream_windowed_drop": s.stream_windowed_drop,
        "stream_dedup": s.stream_dedup,
        "load_once": s.load_once_query,
        "upsert_bucketed": s.upsert_bucketed,
        "change_feed": s.change_feed,
        "checks_one_scan": s.checks_one_scan,
        "stored_failures_rerun": s.stored_failures_rerun,
    }


# Registered model name -> key in ``build_models``.
MODEL_KEYS = {name: name for name in FEED_MODELS}
MODEL_KEYS["stg_quarantine_rollup"] = "quarantine_union"
# Models over the odd feed, in which their rules find rows.
ODD_MODELS = {f"{name}_odd_feed": name for name in ("stg_price__bad", "stg_reviews__bad", "stg_offers__bad", "stg_aplus_module__bad")}


# Columns compared of models that also carry nested ones.
COLUMNS = {"stg_base": ("stg_row_id", "asin", "title", "brand", "product_type_id", "monthly_sold", "csv_text_values",
                        "_airbyte_raw_id", "ingest_ts")}
# The roll-up reads five models: the base is written once and every branch reads its columns from there.
STAGED_BASE = {"stg_quarantine_rollup"}


def written(base: DataFrame, name: str) -> DataFrame:
    """``base`` written once and read from there, for models that read it more than once."""
    path = shared_path(base.sparkSession, f"base-{name}")
    base.write.parquet(path)
    return base.sparkSession.read.schema(base.schema).parquet(path)


def model_query(model: str) -> Query:
    """The named model computed from the feed derived from the driver tables."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = product_feed(spark, sf_dir)
        if model in STAGED_BASE:
            base = product_base(feed).select("asin", "ingest_ts", "_airbyte_raw_id", "csv_v", "csv_text_values", "offers_v", "aplus_v")
            return quarantine_models(written(base, model))
        out = build_models(feed)[MODEL_KEYS[model]]
        if model == "core_product_latest":
            out = out.withColumn("category_tree_v", F.to_json("category_tree_v"))  # compared as text
        return out.select(*COLUMNS[model]) if model in COLUMNS else out
    run.__name__ = model
    return run


def quarantine_rollup_odd_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up over a feed in which the price, offer and A+ rules find rows."""
    base = product_base(odd_feed(spark, sf_dir)).select(
        "asin", "ingest_ts", "_airbyte_raw_id", "csv_v", "csv_text_values", "offers_v", "aplus_v")
    return quarantine_models(written(base, "odd-feed"))


def odd_model_query(model: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_models(odd_feed(spark, sf_dir))[model]
    run.__name__ = model
    return run


# Models computed from the feed loaded as nested NDJSON; the nested ones by lateral joins over the VARIANT.
NDJSON_MODELS = {
    "fct_price_history_daily": lambda raw: build_models(raw)["fct_price_history_daily"],
    # reads two series: the lines are parsed once for both
    "fct_review_history_daily": lambda raw: build_models(None, written(product_base(raw).select("asin", "ingest_ts", "csv_v"), "ndjson-reviews"))[
        "fct_review_history_daily"],
    "stg_videos": stg.variant_videos,
    "stg_offer_metadata": stg.variant_offer_metadata,
    "stg_aplus_module": stg.variant_aplus_module,
}


def ndjson_query(model: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return NDJSON_MODELS[model](ndjson_feed(spark, sf_dir))
    run.__name__ = f"ndjson_{model}"
    return run


def stream_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stg_reviews`` by two watermarked streams of rating and count points: one run for each year, and one after the
    marks have passed the last point."""
    sides = [f"{shared_path(spark, 'review-points')}/{name}" for name in ("rating", "count")]
    folders = [f"{shared_path(spark, 'review-stream')}/{name}" for name in ("rating", "count")]
    for points, path in zip(stg.review_sides(product_base(product_feed(spark, sf_dir))), sides):
        points.withColumn("snapshot_ts", stg.minutes_to_ts("series_min")).write.parquet(path)
    points = [spark.read.parquet(path) for path in sides]
    target, checkpoint = shared_path(spark, "stream-reviews"), shared_path(spark, "stream-reviews-ckpt")

    def run(parts) -> None:
        for part, folder in zip(parts, folders):
            part.write.mode("append").parquet(folder)
        stream_full_outer(spark, *[table_stream(spark, folder, None) for folder in folders], target, ["asin"], "snapshot_ts", checkpoint)

    times = points[0].select("snapshot_ts").unionByName(points[1].select("snapshot_ts"))
    first, last = times.agg(F.min("snapshot_ts"), F.max("snapshot_ts")).first()
    for year in range(first.year, last.year + 1):
        run([p.filter(F.year("snapshot_ts") == year) for p in points])
    mark = [spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in p.dtypes]).withColumn(
        "snapshot_ts", F.lit(last + timedelta(days=days))) for p, days in zip(points, (10, 11))]
    run(mark)  # points without a product, ahead of all others, which no run gives out
    return stg.review_points(spark.read.parquet(target))


def model_queries() -> dict[str, Query]:
    return {**{name: model_query(name) for name in MODEL_KEYS}, "quarantine_rollup_odd_feed": quarantine_rollup_odd_feed,
            **{name: odd_model_query(model) for name, model in ODD_MODELS.items()},
            **{f"ndjson_{model}": ndjson_query(model) for model in NDJSON_MODELS}}


def all_queries() -> dict[str, Query]:
    q = standin_queries()
    q.update(model_queries())
    return q


def all_oracles() -> dict[str, str]:
    q = all_queries()
    sql = dict(oracle_queries())
    sql.update(feed_oracles())
    return {k: v for k, v in sql.items() if k in q}
