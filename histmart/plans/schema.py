"""Typed shape of one raw product snapshot (the STG boundary).

Names are the feed's JSON names, case-exact. ``csv`` is read as text
elements and cast per element afterwards, so one non-numeric value NULLs
that value only (and is reported), not the whole history.
"""

from __future__ import annotations

from pyspark.sql import types as T

OFFER = T.StructType([
    T.StructField("offerId", T.StringType()),
    T.StructField("sellerId", T.StringType()),
    T.StructField("isPrime", T.BooleanType()),
    T.StructField("isFBA", T.BooleanType()),
    T.StructField("condition", T.StringType()),
    T.StructField("isShippable", T.BooleanType()),
    T.StructField("isMAP", T.BooleanType()),
    T.StructField("shipping", T.LongType()),
    T.StructField("offerCSV", T.StringType()),
])

APLUS_MODULE = T.StructType([
    T.StructField("image", T.ArrayType(T.StringType())),
    T.StructField("imageAltText", T.ArrayType(T.StringType())),
    T.StructField("text", T.ArrayType(T.StringType())),
    T.StructField("video", T.ArrayType(T.StringType())),
])

APLUS = T.StructType([T.StructField("module", T.ArrayType(APLUS_MODULE))])

VIDEO = T.StructType([
    T.StructField("creator", T.StringType()),
    T.StructField("duration", T.LongType()),
    T.StructField("image", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
])

CATEGORY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("catId", T.LongType()),
    T.StructField("parent", T.LongType()),
    T.StructField("level", T.LongType()),
    T.StructField("name", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("asin", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("binding", T.StringType()),
    T.StructField("color", T.StringType()),
    T.StructField("manufacturer", T.StringType()),
    T.StructField("productGroup", T.StringType()),
    T.StructField("productType", T.LongType()),
    T.StructField("availabilityAmazon", T.LongType()),
    T.StructField("websiteDisplayGroup", T.StringType()),
    T.StructField("websiteDisplayGroupName", T.StringType()),
    T.StructField("csv", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("salesRanks", T.StringType()),
    T.StructField("offers", T.ArrayType(OFFER)),
    T.StructField("aPlus", T.ArrayType(APLUS)),
    T.StructField("videos", T.ArrayType(VIDEO)),
    T.StructField("categoryTree", T.ArrayType(CATEGORY)),
    T.StructField("buyBoxSellerIdHistory", T.StringType()),
    T.StructField("ratingHistory", T.StringType()),
    T.StructField("reviewCountHistory", T.StringType()),
    T.StructField("monthlySold", T.LongType()),
    T.StructField("monthlySoldHistory", T.ArrayType(T.LongType())),
])

RAW_RECORD = T.StructType([
    T.StructField("_airbyte_raw_id", T.StringType()),
    T.StructField("_airbyte_extracted_at", T.TimestampType()),
    T.StructField("_airbyte_data", PRODUCT),
])
