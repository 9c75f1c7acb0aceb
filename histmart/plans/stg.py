"""Staging models: typed base row and one decoded series/entity per model.

Each function maps DataFrames to a DataFrame; the increment filters and the
key upserts are applied by ``plans.pipeline`` when the model is published.
All decoding is row-local (no shuffle); the only shuffles are the
dedups by model key, which are planned with a map-side partial top-1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmart.functions import (
    minutes_to_ts, month_start, nullif_empty, scaled, sentinel_flag, sentinel_to_null,
    surrogate_key, try_number, ts_text, ts_text_iso, in_price_band,
)
from histmart.operators import (
    PRICE_CHANNELS, RANK_CHANNEL, RATING_CHANNEL, REVIEW_COUNT_CHANNEL,
    SPREAD, channel_array, explode_channels, explode_pairs, flatten, flatten_variant, full_outer_series, inline_dealt, latest_per_key,
    previous_in_array, tagged_assets, text_to_tokens,
)
from histmart.plans.schema import APLUS_MODULE, OFFER, PRODUCT, VIDEO

PRICE_TYPE = "decimal(18,2)"
RATING_TYPE = "decimal(3,1)"
DAY_MINUTES = 1440

# A+ asset kinds (tag, module field, output column).
APLUS_ASSET_KINDS = (
    ("image", "image", "url"),
    ("image_alt", "imageAltText", "alt_text"),
    ("text", "text", "text"),
    ("video", "video", "url"),
)


def _raw_fields(raw: DataFrame):
    """(data field getter, raw id, extracted-at) for RAW given as VARIANT or typed struct.

    VARIANT input is read one path per field, so a model that needs two
    fields decodes two paths: every field is its own expression and
    Catalyst prunes the ones nobody selects. Typed input (a Parquet RAW
    landing, nested under ``_airbyte_data`` or flat) is plain column access,
    pruned down to the scan.
    """
    if "payload" in raw.columns:
        fields = {f.name: f.dataType for f in PRODUCT.fields}

        def get(name):
            dtype = fields[name].simpleString()
            return F.try_variant_get(F.col("payload"), f"$._airbyte_data.{name}", dtype)
        rid = F.try_variant_get(F.col("payload"), "$._airbyte_raw_id", "string")
        ext = F.try_variant_get(F.col("payload"), "$._airbyte_extracted_at", "timestamp")
        return get, rid, ext

    types = {f.name: f.dataType for f in PRODUCT.fields}
    if "_airbyte_data" in raw.columns:
        present = set(raw.schema["_airbyte_data"].dataType.fieldNames())
        field = lambda name: F.col("_airbyte_data")[name]
    else:  # flat landing: one top-level column per product field
        present = set(raw.columns)
        field = F.col

    def get_typed(name):
        if name in present:
            return field(name)
        return F.lit(None).cast(types[name])
    return get_typed, F.col("_airbyte_raw_id"), F.col("_airbyte_extracted_at")


def _is_integer_series(raw: DataFrame) -> bool:
    if "csv" not in raw.columns:
        return False
    return raw.schema["csv"].dataType.simpleString() == "array<array<bigint>>"


def product_base(raw: DataFrame) -> DataFrame:
    """RAW (payload VARIANT or typed ``_airbyte_data`` + lineage) -> typed base snapshot row.

    Fields that do not fit their type become NULL individually.
    ``csv_text_values`` counts series elements that are not integers (they
    are NULL in ``csv_v``).
    """
    d, raw_id, extracted = _raw_fields(raw)
    csv_text = d("csv")
    if _is_integer_series(raw):
        # typed landing: already integers, nothing to cast or count
        csv_v, bad_values = csv_text, F.lit(0)
    else:
        csv_v = F.transform(csv_text, lambda ch: F.transform(ch, lambda x: x.try_cast("bigint")))
        bad_values = F.aggregate(
            F.transform(csv_text, lambda ch: F.size(F.filter(
                ch, lambda x: x.isNotNull() & x.try_cast("bigint").isNull()))),
            F.lit(0), lambda acc, n: acc + F.coalesce(n, F.lit(0)))
    has_file = "file_name" in raw.columns
    out = raw.select(
        d("asin").alias("asin"),
        d("title").alias("title"),
        d("brand").alias("brand"),
        d("binding").alias("binding"),
        d("color").alias("color"),
        d("manufacturer").alias("manufacturer"),
        d("productGroup").alias("product_group"),
        d("productType").alias("product_type_id"),
        d("availabilityAmazon").alias("availability_amazon"),
        d("websiteDisplayGroup").alias("website_display_group"),
        d("websiteDisplayGroupName").alias("website_display_group_name"),
        csv_v.alias("csv_v"),
        d("salesRanks").alias("salesranks_v"),
        d("offers").alias("offers_v"),
        d("aPlus").alias("aplus_v"),
        d("videos").alias("videos_v"),
        d("categoryTree").alias("category_tree_v"),
        d("buyBoxSellerIdHistory").alias("buybox_history_v"),
        d("ratingHistory").alias("rating_history_v"),
        d("reviewCountHistory").alias("review_count_history_v"),
        d("monthlySold").alias("monthly_sold"),
        d("monthlySoldHistory").alias("monthly_sold_history_v"),
        bad_values.alias("csv_text_values"),
        (F.col("file_name") if has_file else F.lit(None).cast("string")).alias("filename"),
        (F.col("file_modified") if has_file else F.lit(None).cast("timestamp")).alias("last_modified"),
        raw_id.alias("_airbyte_raw_id"),
        extracted.alias("_airbyte_extracted_at"),
        F.col("ingest_dt").alias("ingest_ts"),
    )
    key = surrogate_key(F.coalesce(F.col("asin"), F.lit("NULL")), F.col("ingest_ts").cast("string"),
                        F.coalesce(F.col("_airbyte_raw_id"), F.lit("NULL")))
    return out.select(key.alias("stg_row_id"), *out.columns)


# Total orders of the merged models: the row that comes first stays, in a full run
# and in every merge. Columns named _o_* are kept in the published table for it.
ORDERS = {
    "stg_price": ("ingest_ts", "price", "was_sentinel"),
    "stg_rank": ("ingest_ts", "rank"),
    "stg_reviews_rating_pts": ("ingest_ts", "raw_rating"),
    "stg_reviews_count_pts": ("ingest_ts", "raw_count"),
    "stg_offers": ("ingest_ts", "offer_csv_raw", "seller_id", "is_prime", "is_fba", "condition",
                   "is_shippable", "is_map"),
    "stg_offer_metadata": ("seller_id", "shipping_dollars", "condition_code", "is_prime", "is_map"),
    "stg_offer_price": ("ingest_ts", "price"),
    "stg_buybox_history": ("ingest_ts", "seller_id"),
    "stg_category_tree": ("ingest_ts", "category_name", "category_level"),
    "stg_sales_monthly_stats": ("ingest_ts", "_o_series_minutes", "est_units_sold"),
    "stg_videos": ("snapshot_ts", "title", "creator", "duration_sec", "thumbnail_url", "name"),
    "stg_aplus_module": ("ingest_ts", "url", "alt_text", "text"),
}


def desc(columns) -> list[tuple[str, str]]:
    return [(c, "desc") for c in columns]


def price_points(base: DataFrame) -> DataFrame:
    """Every price point of every load, not deduplicated, dealt by product (``_spread``: by day where there is none)."""
    numbered = [(i, at) for i, (_, at) in enumerate(PRICE_CHANNELS)]  # a channel goes by its number until it has been shuffled
    pairs = channel_array("csv_v", numbered, keep_partial=False, name="channel", key_name="series_min", value_name="raw_val")
    pairs = F.transform(pairs, lambda p: F.struct(p["channel"].alias("channel"), p["series_min"].alias("series_min"), p["raw_val"].alias("raw_val")))
    pts = inline_dealt(base.select("asin", "csv_v", "ingest_ts"), pairs, "asin", ["ingest_ts"],
                       lambda p: F.floor(p["series_min"] / DAY_MINUTES))
    return _prices(pts.withColumn("price_channel", F.get(F.array(*[F.lit(name) for name, _ in PRICE_CHANNELS]), F.col("channel"))), SPREAD)


def plain_price_points(base: DataFrame) -> DataFrame:
    """The same points where the load lies, for a step that reduces them before any shuffle."""
    return _prices(explode_channels(base.select("asin", "csv_v", "ingest_ts"), "csv_v", PRICE_CHANNELS, keep=["asin", "ingest_ts"],
                                    keep_partial=False, name="price_channel", key_name="series_min", value_name="raw_val"))


def _prices(pts: DataFrame, *dealt: str) -> DataFrame:
    return pts.select(
        "asin", *dealt, "price_channel",
        minutes_to_ts("series_min").alias("snapshot_ts"),
        sentinel_to_null("raw_val", 100, PRICE_TYPE).alias("price"),
        sentinel_flag("raw_val").alias("was_sentinel"),
        "ingest_ts")


def stg_price(base: DataFrame) -> DataFrame:
    """Price points of the four price channels; every full pair is decoded."""
    return price_of(price_points(base))


def price_of(points: DataFrame) -> DataFrame:
    """The price model from the points of every load."""
    dealt = [SPREAD] if SPREAD in points.columns else []
    pts = latest_per_key(points, ["asin", *dealt, "price_channel", "snapshot_ts"], desc(ORDERS["stg_price"])).drop(SPREAD)
    return pts.select(surrogate_key("asin", "price_channel", ts_text("snapshot_ts")).alias("pk"),
                      *pts.columns)


def _channel_pairs(base: DataFrame, channel: int, key: str, value: str) -> DataFrame:
    return explode_pairs(base.select("asin", "ingest_ts", F.get(F.col("csv_v"), F.lit(channel)).alias("_s")),
                         "_s", keep=["asin", "ingest_ts"], keep_partial=True,
                         key_name=key, value_name=value).drop("pair_idx")


def rank_points(base: DataFrame) -> DataFrame:
    """Every rank point of every load, not deduplicated."""
    return _channel_pairs(base, RANK_CHANNEL, "series_min", "raw_rank").select(
        "asin", minutes_to_ts("series_min").alias("snapshot_ts"),
        sentinel_to_null("raw_rank").alias("rank"), "ingest_ts")


def stg_rank(base: DataFrame) -> DataFrame:
    """Sales-rank points (odd trailing minute kept with NULL rank)."""
    return rank_of(rank_points(base))


def rank_of(points: DataFrame) -> DataFrame:
    """The rank model from the points of every load."""
    pts = latest_per_key(points, ["asin", "snapshot_ts"], desc(ORDERS["stg_rank"]))
    return pts.select(surrogate_key("asin", ts_text("snapshot_ts")).alias("pk"), *pts.columns)


def review_sides(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rating and review-count points, each reduced to its newest load per (asin, minute)."""
    return newest_sides(*review_pairs(base))


def review_pairs(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rating and review-count points of every load, not deduplicated."""
    return (_channel_pairs(base, RATING_CHANNEL, "series_min", "raw_rating"),
            _channel_pairs(base, REVIEW_COUNT_CHANNEL, "series_min", "raw_count"))


def newest_sides(r: DataFrame, c: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (latest_per_key(r, ["asin", "series_min"], desc(ORDERS["stg_reviews_rating_pts"])),
            latest_per_key(c, ["asin", "series_min"], desc(ORDERS["stg_reviews_count_pts"])))


def reviews_from_sides(r: DataFrame, c: DataFrame) -> DataFrame:
    """Join the two series on (asin, minute); the rating side's load stamp wins."""
    j = full_outer_series(r, c, ["asin", "series_min"],
                          coalesce_extra=[("ingest_ts", "ingest_ts", "ingest_ts")])
    return review_points(j)


def review_values(rows: DataFrame, rating_type: str | None = RATING_TYPE) -> DataFrame:
    """Review rows of raw points; without ``rating_type`` also of points that do not fit it."""
    return rows.select(
        "asin", "series_min", minutes_to_ts("series_min").alias("snapshot_ts"),
        sentinel_to_null("raw_rating", 10, rating_type).alias("rating"),
        sentinel_to_null("raw_count").alias("review_count"), "ingest_ts")


def review_points(joined: DataFrame) -> DataFrame:
    """Review rows of the joined series, one per (asin, minute)."""
    pts = review_values(joined).drop("series_min")
    pts = latest_per_key(pts, ["asin", "snapshot_ts"], [("ingest_ts", "desc")],
                         tie_break=[("rating", "desc"), ("review_count", "desc")])
    pk = surrogate_key(F.coalesce(F.col("asin"), F.lit("NULL")), ts_text("snapshot_ts"))
    return pts.select(pk.alias("pk"), *pts.columns)


def stg_reviews(base: DataFrame) -> DataFrame:
    """Rating (tenths) and review-count points joined on (asin, minute)."""
    return reviews_from_sides(*review_sides(base))


OFFER_FIELDS = (("offerId", "offer_id"), ("sellerId", "seller_id"), ("isPrime", "is_prime"),
                ("isFBA", "is_fba"), ("condition", "condition"), ("isShippable", "is_shippable"),
                ("isMAP", "is_map"), ("offerCSV", "offer_csv_raw"))


def offer_snapshots(base: DataFrame) -> DataFrame:
    """Every offer of every load (outer flatten: products without offers keep a NULL row)."""
    o = flatten(base.select("asin", "ingest_ts", "offers_v"), "offers_v",
                keep=["asin", "ingest_ts"], outer=True, index="offer_idx", value="o")
    return o.select("asin", *[F.col("o")[f].alias(n) for f, n in OFFER_FIELDS], "ingest_ts")


def stg_offers(base: DataFrame) -> DataFrame:
    """Latest attributes and raw price text per (asin, offer)."""
    return offers_of(offer_snapshots(base))


def offers_of(o: DataFrame) -> DataFrame:
    """The offer model from the offer snapshots of every load."""
    o = latest_per_key(o, ["asin", "offer_id"], desc(ORDERS["stg_offers"]))
    return o.select(surrogate_key("asin", "offer_id").alias("stg_offer_id"), *o.columns)


def stg_offer_metadata(base: DataFrame) -> DataFrame:
    """Offer attributes per (asin, offer, load); shipping cents -> dollars."""
    return offer_metadata_of(flatten(base.select("asin", "ingest_ts", "offers_v").filter(F.col("offers_v").isNotNull()),
                                     "offers_v", keep=["asin", "ingest_ts"], outer=False, index="offer_idx", value="o"))


def offer_metadata_of(rows: DataFrame) -> DataFrame:
    """The offer metadata model from one row per offer (asin, ingest_ts, o)."""
    o = rows.select(
        "asin", F.col("o.offerId").alias("offer_id"), F.col("o.sellerId").alias("seller_id"),
        F.col("o.isPrime").alias("is_prime"), F.col("o.isMAP").alias("is_map"),
        F.col("o.condition").alias("condition_code"),
        scaled(F.col("o.shipping"), 100, PRICE_TYPE).alias("shipping_dollars"), "ingest_ts")
    o = latest_per_key(o, ["asin", "offer_id", "ingest_ts"], desc(ORDERS["stg_offer_metadata"]))
    key = surrogate_key("asin", "offer_id", F.col("ingest_ts").cast("string"))
    return o.select(key.alias("stg_offer_meta_id"), *o.columns)


def offer_price_points(offers: DataFrame) -> DataFrame:
    """Every offer price point of every load from the comma text; keeps sentinels and 0 < p <= 400."""
    src = offers.filter(F.col("offer_csv_raw").isNotNull() & (F.col("offer_csv_raw") != ""))
    pts = explode_pairs(src.select("asin", "offer_id", "ingest_ts",
                                   text_to_tokens("offer_csv_raw").alias("_t")),
                        "_t", keep=["asin", "offer_id", "ingest_ts"], keep_partial=False,
                        key_name="min_t", value_name="price_t")
    raw = scaled(try_number("price_t"), 100)
    return (pts.select("asin", "offer_id", minutes_to_ts(try_number("min_t")).alias("snapshot_ts"),
                       raw.alias("price_dollars_raw"), "ingest_ts")
            .filter(in_price_band("price_dollars_raw"))
            .select("asin", "offer_id", "snapshot_ts",
                    sentinel_to_null("price_dollars_raw", None, PRICE_TYPE).alias("price"),
                    sentinel_flag("price_dollars_raw").alias("was_sentinel"), "ingest_ts"))


def stg_offer_price(offers: DataFrame) -> DataFrame:
    """Offer price points, one per (asin, offer, minute).

    ``offers`` are the offer snapshots of every load (``offer_snapshots``), so
    the history keeps the points of older loads too; a point present in
    several loads takes the newest load. Merging increments therefore gives
    the same table as one full run.
    """
    pts = latest_per_key(offer_price_points(offers), ["asin", "offer_id", "snapshot_ts"], desc(ORDERS["stg_offer_price"]))
    key = surrogate_key("asin", "offer_id", ts_text("snapshot_ts"))
    return pts.select(key.alias("stg_offer_price_id"), *pts.columns)


def stg_buybox_history(base: DataFrame) -> DataFrame:
    """Buy-box holder changes (minute, seller) from text or JSON-array history."""
    src = base.select("asin", "ingest_ts", "buybox_history_v").filter(
        F.col("buybox_history_v").isNotNull())
    pts = explode_pairs(src.select("asin", "ingest_ts", text_to_tokens("buybox_history_v").alias("_t")),
                        "_t", keep=["asin", "ingest_ts"], keep_partial=False,
                        key_name="min_t", value_name="seller_t")
    pts = pts.select("asin", minutes_to_ts(try_number("min_t")).alias("snapshot_ts"),
                     nullif_empty("seller_t").alias("seller_id"), "ingest_ts")
    pts = latest_per_key(pts, ["asin", "snapshot_ts"], desc(ORDERS["stg_buybox_history"]))
    key = surrogate_key("asin", ts_text("snapshot_ts"), F.coalesce(F.col("seller_id"), F.lit("NULL")))
    return pts.select(key.alias("stg_buybox_row_id"), *pts.columns)


def stg_category_tree(base: DataFrame) -> DataFrame:
    """Category edges per product; ``id``/``catId`` and ``parent``/previous element unified."""
    src = base.select("asin", "ingest_ts", "category_tree_v").filter(
        F.col("category_tree_v").isNotNull())
    paired = src.select("asin", "ingest_ts",
                        previous_in_array(F.col("category_tree_v")).alias("_p"))
    e = flatten(paired, "_p", keep=["asin", "ingest_ts"], index="idx", value="e")
    cur, prev = F.col("e.item"), F.col("e.previous")
    e = e.select(
        "asin",
        F.coalesce(cur["id"], cur["catId"]).alias("category_id"),
        F.coalesce(cur["parent"], prev["id"], prev["catId"]).alias("parent_category_id"),
        cur["level"].alias("category_level"),
        cur["name"].alias("category_name"),
        "ingest_ts")
    e = latest_per_key(e, ["asin", "category_id", "parent_category_id"], desc(ORDERS["stg_category_tree"]))
    key = surrogate_key("asin", "category_id", "parent_category_id", null_token="NULL")
    return e.select(key.alias("stg_category_row_id"), *e.columns)


PRODUCT_ATTRS = ("title", "brand", "manufacturer", "binding", "color", "product_group",
                 "product_type_id", "website_display_group", "website_display_group_name")


ORDERS["stg_product_metadata"] = ("_o_extracted_at", "_o_raw_id", *PRODUCT_ATTRS)


def stg_product_metadata(base: DataFrame, hidden: bool = False) -> DataFrame:
    """Product attributes, one row per (asin, load). ``hidden`` keeps the order columns."""
    src = base.filter(F.col("asin").isNotNull()).select(
        "asin", *PRODUCT_ATTRS, "ingest_ts", F.col("_airbyte_extracted_at").alias("_o_extracted_at"),
        F.col("_airbyte_raw_id").alias("_o_raw_id"))
    src = latest_per_key(src, ["asin", "ingest_ts"], desc(ORDERS["stg_product_metadata"]))
    key = surrogate_key("asin", F.col("ingest_ts").cast("string"))
    return src.select(key.alias("stg_product_meta_id"), "asin", *PRODUCT_ATTRS, "ingest_ts",
                      *(["_o_extracted_at", "_o_raw_id"] if hidden else []))


def stg_sales_monthly_stats(base: DataFrame, hidden: bool = False) -> DataFrame:
    """Units sold per month from the flat monthly history; latest point wins. ``hidden`` keeps the order column."""
    src = base.filter(F.col("asin").isNotNull()).select("asin", "ingest_ts", "monthly_sold_history_v")
    pts = explode_pairs(src, "monthly_sold_history_v", keep=["asin", "ingest_ts"], keep_partial=True,
                        key_name="series_minutes", value_name="est_units_sold")
    pts = (pts.filter(F.col("series_minutes").isNotNull())
           .select("asin", month_start(minutes_to_ts("series_minutes")).alias("sales_month"),
                   F.col("series_minutes").alias("_o_series_minutes"), "est_units_sold", "ingest_ts"))
    pts = latest_per_key(pts, ["asin", "sales_month"], desc(ORDERS["stg_sales_monthly_stats"]))
    key = surrogate_key(F.coalesce(F.col("asin"), F.lit("NULL")), F.col("sales_month").cast("string"))
    return pts.select(key.alias("stg_sales_stats_id"), "asin", "sales_month", "est_units_sold",
                      "ingest_ts", *(["_o_series_minutes"] if hidden else []))


def stg_videos(base: DataFrame) -> DataFrame:
    """Latest video per (asin, url or name); rows with neither are dropped."""
    return videos_of(flatten(base.select("asin", "ingest_ts", "videos_v"), "videos_v", keep=["asin", "ingest_ts"],
                             outer=True, index="video_idx", value="v"))


def videos_of(rows: DataFrame) -> DataFrame:
    """The video model from one row per video (asin, ingest_ts, v)."""
    v = rows.withColumnRenamed("ingest_ts", "snapshot_ts").select("asin", "snapshot_ts", F.col("v.creator").alias("creator"),
                 sentinel_to_null(F.col("v.duration")).alias("duration_sec"),
                 F.col("v.image").alias("thumbnail_url"), F.col("v.name").alias("name"),
                 F.col("v.title").alias("title"), F.col("v.url").alias("url"))
    v = v.filter(F.col("url").isNotNull() | F.col("name").isNotNull())
    v = v.withColumn("_vk", F.coalesce("url", "name"))
    v = latest_per_key(v, ["asin", "_vk"], desc(ORDERS["stg_videos"]))
    key = surrogate_key("asin", "_vk", ts_text_iso("snapshot_ts"))
    return v.select(key.alias("stg_video_id"), "asin", "snapshot_ts", "creator", "duration_sec",
                    "thumbnail_url", "name", "title", "url")


def stg_aplus_module(base: DataFrame) -> DataFrame:
    """A+ content: aPlus[] -> module[] -> four asset arrays, one row per asset."""
    a = flatten(base.select("asin", "ingest_ts", "aplus_v"), "aplus_v", keep=["asin", "ingest_ts"],
                outer=True, index="aplus_idx", value="a")
    return aplus_of(flatten(a.select("asin", "ingest_ts", "aplus_idx", F.col("a.module").alias("mods")), "mods",
                            keep=["asin", "aplus_idx", "ingest_ts"], outer=True, index="module_idx", value="mod_v"))


def aplus_of(modules: DataFrame) -> DataFrame:
    """The A+ model from one row per module (asin, aplus_idx, module_idx, ingest_ts, mod_v).

    Modules are dealt by product before they become assets, and a module that several loads bring unchanged goes on once,
    with the load that comes first (a NULL load does).
    """
    newest = F.when(F.count("ingest_ts") == F.count(F.lit(1)), F.max("ingest_ts"))
    modules = modules.repartition("asin").groupBy("asin", "aplus_idx", "module_idx", "mod_v").agg(newest.alias("ingest_ts"))
    assets = modules.select("asin", "aplus_idx", "module_idx", "ingest_ts",
                      F.inline(tagged_assets(F.col("mod_v"), APLUS_ASSET_KINDS)))
    assets = assets.select("asin", F.col("aplus_idx").cast("int").alias("aplus_idx"),
                           F.col("module_idx").cast("int").alias("module_idx"),
                           "asset_type", "asset_idx", "url", "alt_text", "text", "ingest_ts")
    keys = ["asin", "aplus_idx", "module_idx", "asset_type", "asset_idx"]
    assets = latest_per_key(assets, keys, desc(ORDERS["stg_aplus_module"]))
    return assets.select(surrogate_key(*keys).alias("stg_aplus_id"), *assets.columns)


# ---- the nested models straight from RAW VARIANT, flattened by lateral joins

def _payload(raw: DataFrame) -> DataFrame:
    get, _, _ = _raw_fields(raw)
    return raw.select(get("asin").alias("asin"), F.col("ingest_dt").alias("ingest_ts"), "payload")


def _typed(value: str, schema) -> Column:
    return F.try_variant_get(F.col(value), "$", schema.simpleString())


def variant_videos(raw: DataFrame) -> DataFrame:
    """``stg_videos`` from RAW rows with a VARIANT payload."""
    v = flatten_variant(_payload(raw), "payload", "$._airbyte_data.videos", outer=True, out="e")
    return videos_of(v.select("asin", "ingest_ts", _typed("e", VIDEO).alias("v")))


def variant_offer_metadata(raw: DataFrame) -> DataFrame:
    """``stg_offer_metadata`` from RAW rows with a VARIANT payload."""
    o = flatten_variant(_payload(raw), "payload", "$._airbyte_data.offers", out="e")
    return offer_metadata_of(o.select("asin", "ingest_ts", _typed("e", OFFER).alias("o")))


def variant_aplus_module(raw: DataFrame) -> DataFrame:
    """``stg_aplus_module`` from RAW rows with a VARIANT payload: two chained lateral joins."""
    a = flatten_variant(_payload(raw), "payload", "$._airbyte_data.aPlus", outer=True, index="aplus_idx", out="a")
    m = flatten_variant(a.drop("key"), "a", "$.module", outer=True, index="module_idx", out="e")
    return aplus_of(m.select("asin", "aplus_idx", "module_idx", "ingest_ts", _typed("e", APLUS_MODULE).alias("mod_v")))
