"""A product-snapshot feed derived from the driver tables.

The driver tables carry no product feed, so one is derived by a fixed rule:
every line item becomes one raw snapshot of product ``'P' || l_partkey``
loaded on its ship day, with its series, offers, buy-box text, videos and
A+ content built *inside the row* from the line item and its part. The
derivation is one join (lineitem x part on the part key) and row-local
expressions, so the feed grows linearly with ``lineitem`` and the models
downstream see many loads per product, several on the same day, odd
series tails, sentinels, empty and NULL arrays and out-of-range values.

The rule, in words (the SQL twin in ``plans.feed_oracle`` follows it too):

* m = minutes from 2011-01-01 to l_shipdate; unit = l_extendedprice / l_quantity
* csv[0] (AMAZON)    = [m, round(unit*100), m+1440, round(unit*(1-l_discount)*100)]
* csv[1] (NEW)       = [m, -1 if l_returnflag = 'R' else round(p_retailprice*100)]
* csv[2] (USED)      = []
* csv[3] (rank)      = [m, l_suppkey, m+60, l_linenumber-1, m+120]
* csv[4] (LISTPRICE) = [m, round(p_retailprice*100)]
* csv[16] (rating)   = [m, round(l_tax*1000)]
* csv[17] (reviews)  = [m, l_quantity, m+30, 2*l_quantity]
* offers   = one offer 'O'||l_suppkey, seller 'S'||l_suppkey, text series
             'm,round(unit),m+1440,(-1 if flag N else round(unit*(1-disc))),m+2880,0'
* buy box  = tokens [m, 'S'||l_suppkey, m+10, ''] as JSON array text when
             l_linenumber is odd, else as comma text
* monthly sold = [m, l_quantity, m+43200, l_quantity+l_linenumber, m+86400]
* category tree = [{catId: length(p_type), name: p_type},
                   {catId: 100+p_size, name: p_type||'/'||p_size}]
* videos   = [{creator p_brand, duration -1 if flag R else 10*l_quantity,
               name 'clip '||l_suppkey, title p_name,
               url 'https://v/'||l_suppkey if l_linestatus = 'O' else NULL}]
* A+       = [{module: [{image: words of p_name, imageAltText: [p_type], text: [],
               video: NULL}, {all four empty}]}]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.functions import ts_to_minutes
from histmart.session import shared_path
from histmart.sources import read_ndjson, spread, table


def _bigint(c):
    return F.round(c).cast("bigint")


# Lines of a file of the NDJSON feed: a line is some 70 times a stored line item, and a gzip file is written and read by one task.
FILE_LINES = 50_000


def product_feed(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """RAW rows (one typed column per product field + lineage, ingest_dt) from lineitem x part, the line items dealt over
    ``partitions`` where given.

    The rows arrive typed, like a Parquet landing of the feed; the NDJSON
    path (VARIANT payload) is exercised by ``read_ndjson`` on real files.
    """
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"), partitions)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                               "p_retailprice")
    j = li.join(part, li["l_partkey"] == part["p_partkey"], "inner")

    m = ts_to_minutes("l_shipdate")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    net = unit * (1 - F.col("l_discount"))
    qty = F.col("l_quantity").cast("bigint")
    supp = F.col("l_suppkey").cast("string")
    retail = _bigint(F.col("p_retailprice") * 100)
    none = F.lit(None).cast("array<bigint>")

    def arr(*xs):
        return F.array(*[x.cast("bigint") for x in xs])

    csv = F.array(
        arr(m, _bigint(unit * 100), m + 1440, _bigint(net * 100)),
        arr(m, F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(retail)),
        F.array().cast("array<bigint>"),
        arr(m, F.col("l_suppkey"), m + 60, F.col("l_linenumber") - 1, m + 120),
        arr(m, retail),
        *[none] * 11,
        arr(m, _bigint(F.col("l_tax") * 1000)),
        arr(m, qty, m + 30, qty * 2),
    )
    offer_csv = F.concat_ws(",", *[c.cast("string") for c in (
        m, _bigint(unit), m + 1440,
        F.when(F.col("l_returnflag") == "N", F.lit(-1)).otherwise(_bigint(net)),
        m + 2880, F.lit(0))])
    offers = F.array(F.struct(
        F.concat(F.lit("O"), supp).alias("offerId"),
        F.concat(F.lit("S"), supp).alias("sellerId"),
        (F.col("l_linestatus") == "O").alias("isPrime"),
        (F.col("l_returnflag") == "A").alias("isFBA"),
        F.col("l_returnflag").alias("condition"),
        F.lit(True).alias("isShippable"),
        F.lit(False).alias("isMAP"),
        _bigint(F.col("l_tax") * 10000).alias("shipping"),
        offer_csv.alias("offerCSV")))
    bb_tokens = F.array(m.cast("string"), F.concat(F.lit("S"), supp), (m + 10).cast("string"), F.lit(""))
    buybox = F.when(F.col("l_linenumber") % 2 == 1, F.to_json(bb_tokens)).otherwise(
        F.array_join(bb_tokens, ","))
    no_id = F.lit(None).cast("bigint")

    def category(cat_id, name):
        return F.struct(no_id.alias("id"), cat_id.cast("bigint").alias("catId"), no_id.alias("parent"),
                        no_id.alias("level"), name.alias("name"))
    categories = F.array(
        category(F.length("p_type"), F.col("p_type")),
        category(F.col("p_size") + 100, F.concat(F.col("p_type"), F.lit("/"), F.col("p_size").cast("string"))))
    videos = F.array(F.struct(
        F.col("p_brand").alias("creator"),
        F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(qty * 10).cast("bigint").alias("duration"),
        F.lit(None).cast("string").alias("image"),
        F.concat(F.lit("clip "), supp).alias("name"),
        F.col("p_name").alias("title"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("https://v/"), supp)).alias("url")))
    empty = F.array().cast("array<string>")
    aplus = F.array(F.struct(F.array(
        F.struct(F.split(F.col("p_name"), " ", -1).alias("image"), F.array(F.col("p_type")).alias("imageAltText"),
                 empty.alias("text"), F.lit(None).cast("array<string>").alias("video")),
        F.struct(empty.alias("image"), empty.alias("imageAltText"), empty.alias("text"),
                 empty.alias("video"))).alias("module")))
    data = (
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("asin"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("binding"),
        F.split(F.col("p_name"), " ", -1).getItem(0).alias("color"),
        F.col("p_brand").alias("manufacturer"),
        F.col("p_type").alias("productGroup"),
        F.col("p_size").cast("bigint").alias("productType"),
        F.lit(0).cast("bigint").alias("availabilityAmazon"),
        F.lower(F.col("p_type")).alias("websiteDisplayGroup"),
        F.col("p_type").alias("websiteDisplayGroupName"),
        csv.alias("csv"),
        offers.alias("offers"),
        aplus.alias("aPlus"),
        videos.alias("videos"),
        categories.alias("categoryTree"),
        buybox.alias("buyBoxSellerIdHistory"),
        qty.alias("monthlySold"),
        arr(m, qty, m + 43200, qty + F.col("l_linenumber"), m + 86400).alias("monthlySoldHistory"),
    )
    # Flat columns (not one struct): each field is its own expression, so a
    # model that reads three fields makes the scan read only their inputs.
    return j.select(
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("_airbyte_raw_id"),
        F.col("l_shipdate").cast("timestamp").alias("_airbyte_extracted_at"),
        *data,
        F.col("l_shipdate").cast("date").alias("ingest_dt"))


def odd_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with what quarantines look for: no product id on seventh line items, no offer id at zero tax,
    empty offer text on sixth line items."""
    feed = product_feed(spark, sf_dir)
    line = F.substring_index("_airbyte_raw_id", "-", -1)
    offer = F.col("offers")[0]
    offer = offer.withField("offerId", F.when(offer["shipping"] != 0, offer["offerId"])).withField(
        "offerCSV", F.when(line == "6", F.lit("")).otherwise(offer["offerCSV"]))
    return feed.withColumn("offers", F.array(offer)).withColumn("asin", F.when(line != "7", F.col("asin")))


def ndjson_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written as nested gzip NDJSON and loaded again: RAW rows with a VARIANT payload, dated by their extraction."""
    feed = product_feed(spark, sf_dir, -(-table(spark, sf_dir, "lineitem").count() // FILE_LINES) or None)
    data = [c for c in feed.columns if c not in ("_airbyte_raw_id", "_airbyte_extracted_at", "ingest_dt")]
    path = shared_path(spark, "ndjson-feed")
    feed.select(F.to_json(F.struct("_airbyte_raw_id", "_airbyte_extracted_at", F.struct(*data).alias("_airbyte_data"))).alias("value")).write.options(
        **{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}).text(path)
    raw, _ = read_ndjson(spark, path, pattern=r"(?i).*\.txt\.gz$")
    day = F.try_variant_get("payload", "$._airbyte_extracted_at", "timestamp").cast("date")
    return raw.select("payload", "file_name", "file_modified", day.alias("ingest_dt"))
