"""Quarantine models (D1-D6): bad rows with reason codes, and their roll-up.

Fixed values: the reason codes, the detail texts and the parts of ``bad_row_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.functions import ts_text
from histmart.operators.quality import Rule, quarantine, quarantine_union


def _txt(c):
    return F.col(c).cast("string")


def price_rules() -> list[Rule]:
    return [Rule("ASIN_NULL", F.col("asin").isNull()),
            Rule("TS_NULL", F.col("snapshot_ts").isNull()),
            Rule("PRICE_NEGATIVE", F.col("price").isNotNull() & (F.col("price") < 0))]


def price_bad(stg_price: DataFrame) -> DataFrame:
    _, bad = quarantine(stg_price, price_rules(),
                        ["asin", "price_channel", ts_text("snapshot_ts"), _txt("ingest_ts")],
                        "Price staging validation failure",
                        keep=["asin", "price_channel", "snapshot_ts", "price", "was_sentinel", "ingest_ts"])
    return bad


def rank_rules() -> list[Rule]:
    return [Rule("ASIN_NULL", F.col("asin").isNull()),
            Rule("TS_NULL", F.col("snapshot_ts").isNull()),
            Rule("RANK_NONPOSITIVE", F.col("rank").isNotNull() & (F.col("rank") <= 0))]


def rank_bad(stg_rank: DataFrame) -> DataFrame:
    _, bad = quarantine(stg_rank, rank_rules(), ["asin", ts_text("snapshot_ts"), _txt("ingest_ts")],
                        "Rank staging validation failure",
                        keep=["asin", "snapshot_ts", "rank", "ingest_ts"])
    return bad


def reviews_rules() -> list[Rule]:
    r, n = F.col("rating"), F.col("review_count")
    return [Rule("ASIN_NULL", F.col("asin").isNull()),
            Rule("TS_NULL", F.col("snapshot_ts").isNull()),
            Rule("RATING_OOB", r.isNotNull() & ((r < 0) | (r > 5))),
            Rule("COUNT_NEGATIVE", n.isNotNull() & (n < 0))]


def reviews_bad(stg_reviews: DataFrame) -> DataFrame:
    _, bad = quarantine(stg_reviews, reviews_rules(), ["asin", ts_text("snapshot_ts"), _txt("ingest_ts")],
                        "Reviews staging validation failure",
                        keep=["asin", "snapshot_ts", "rating", "review_count", "ingest_ts"])
    return bad


def offers_rules() -> list[Rule]:
    csv = F.col("offer_csv_raw")
    return [Rule("ASIN_NULL", F.col("asin").isNull()),
            Rule("OFFER_ID_NULL", F.col("offer_id").isNull()),
            Rule("OFFER_CSV_EMPTY", csv.isNull() | (csv == ""))]


def offers_bad(stg_offers: DataFrame) -> DataFrame:
    _, bad = quarantine(stg_offers, offers_rules(), ["asin", "offer_id", _txt("ingest_ts")],
                        "Offers staging validation failure",
                        keep=["asin", "offer_id", "seller_id", "offer_csv_raw", "ingest_ts"])
    return bad


def aplus_bad(stg_aplus: DataFrame) -> DataFrame:
    """Module-level check: asin missing, or no non-NULL asset in the module."""
    has_asset = F.col("url").isNotNull() | F.col("alt_text").isNotNull() | F.col("text").isNotNull()
    agg = (stg_aplus.groupBy("asin", "aplus_idx", "module_idx")
           .agg(F.count(F.when(has_asset, F.lit(1))).alias("asset_count"),
                F.max("ingest_ts").alias("ingest_ts")))
    rules = [Rule("ASIN_NULL", F.col("asin").isNull()),
             Rule("MODULE_EMPTY", F.col("asset_count") == 0)]
    _, bad = quarantine(agg, rules, ["asin", _txt("aplus_idx"), _txt("module_idx"), _txt("ingest_ts")],
                        "A+ module empty or asin missing",
                        keep=["asin", "aplus_idx", "module_idx", "asset_count", "ingest_ts"])
    return bad


def base_bad(base: DataFrame) -> DataFrame:
    """Snapshot rows whose series hold non-numeric values (the values are NULLed)."""
    rules = [Rule("CSV_NOT_NUMERIC", F.col("csv_text_values") > 0)]
    _, bad = quarantine(base, rules, ["asin", _txt("ingest_ts"), "_airbyte_raw_id"],
                        "non-numeric values in csv series",
                        keep=["asin", "csv_text_values", "ingest_ts"])
    return bad


def quarantine_rollup(price: DataFrame, rank: DataFrame, reviews: DataFrame, offers: DataFrame,
                      aplus: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """All quarantines in one shape; ``base`` adds the snapshots with non-numeric series values."""
    parts = [("price", price), ("rank", rank), ("reviews", reviews), ("offers", offers), ("aplus", aplus)]
    return quarantine_union(parts + ([("base", base)] if base is not None else []),
                            types={"snapshot_ts": "timestamp_ntz", "ingest_ts": "date",
                                   "asin": "string"})
