"""Column functions: keys, time offsets, sentinels, tolerant parsing, price band."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from histmart.functions import (
    in_price_band, json_path, minutes_to_ts, month_start, nullif_empty, sentinel_flag,
    sentinel_to_null, surrogate_key, try_number, ts_text, ts_text_iso, ts_to_minutes,
)


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_surrogate_key_null_handling(spark):
    r = one(spark, surrogate_key(F.lit("A1"), F.lit(None).cast("string")),
            surrogate_key(F.lit("A1"), F.lit(None).cast("string"), null_token="NULL"),
            F.md5(F.lit("A1|NULL")))
    assert r.c0 is None and r.c1 == r.c2


def test_timestamp_text(spark):
    ts = F.lit("2011-01-01 00:00:00").cast("timestamp_ntz")
    r = one(spark, ts_text(ts), ts_text_iso(ts), ts_text(F.lit("2024-03-01").cast("date")))
    assert (r.c0, r.c1, r.c2) == ("2011-01-01 00:00:00.000", "2011-01-01T00:00:00000",
                                   "2024-03-01 00:00:00.000")


def test_minutes_round_trip_and_month(spark):
    r = one(spark, minutes_to_ts(F.lit(50000)), ts_to_minutes(minutes_to_ts(F.lit(-123))),
            month_start(minutes_to_ts(F.lit(50000))), minutes_to_ts(F.lit(None).cast("bigint")))
    assert r.c0 == dt.datetime(2011, 2, 4, 17, 20) and r.c1 == -123
    assert r.c2 == dt.date(2011, 2, 1) and r.c3 is None


def test_sentinels_and_scaling(spark):
    r = one(spark, sentinel_to_null(F.lit(1999), 100, "decimal(18,2)"), sentinel_to_null(F.lit(-1), 100),
            sentinel_flag(F.lit(-1)), sentinel_flag(F.lit(None).cast("int")),
            sentinel_to_null(F.lit(45), 10, "decimal(3,1)"))
    assert (r.c0, r.c1, r.c2, r.c3, r.c4) == (Decimal("19.99"), None, 1, 0, Decimal("4.5"))


def test_try_number_and_empty(spark):
    r = one(spark, try_number(F.lit("1.5")), try_number(F.lit("[1")), try_number(F.lit("-7")),
            nullif_empty(F.lit("")), json_path(F.lit('{"k": 5}'), "$.k", "bigint"),
            json_path(F.lit("{oops"), "$.k", "bigint"), json_path(F.lit('{"K": 5}'), "$.k", "bigint"))
    assert (r.c0, r.c1, r.c2, r.c3, r.c4, r.c5, r.c6) == (2, None, -7, None, 5, None, None)


def test_price_band(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.01,), (400.0,), (400.01,), (None,)], "p double")
    kept = sorted(r.p for r in df.filter(in_price_band("p")).collect())
    assert kept == [-1.0, 0.01, 400.0]
