"""Load marks from Parquet footers: the same values, and a pushed aggregate in the plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from histmart.session import shared_path
from histmart.sources.sink import high_water, newest


@pytest.fixture(scope="module")
def table(spark):
    path = shared_path(spark, "marks")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, day).alias("load"), (F.col("id") % 4).alias("part"),
                                    F.timestamp_seconds(1700000000 + F.col("id")).alias("at"), F.lit(None).cast("date").alias("none"))
    rows.repartition(3).write.partitionBy("part").parquet(path)
    return path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("column,as_date,pushed", [("load", False, True), ("load", True, True), ("id", False, True), ("at", False, False), ("at", True, False)])
def test_marks_equal_a_read(spark, table, column, as_date, pushed):
    c = F.col(column).cast("date") if as_date else F.col(column)
    assert high_water(spark, table, column, as_date) == spark.read.parquet(table).agg(F.max(c)).first()[0]
    assert (f"PushedAggregation: [MAX({column})]" in _plan(newest(spark, table, column, as_date))) == pushed


def test_no_mark(spark, table):
    assert high_water(spark, table, "none") == "1900-01-01"
    assert high_water(spark, shared_path(spark, "no-table"), "load") == "1900-01-01"


def test_the_session_keeps_its_settings(spark, table):
    before = spark.conf.get("spark.sql.sources.useV1SourceList"), spark.conf.get("spark.sql.parquet.aggregatePushdown")
    assert high_water(spark, table, "load") == dt.date(2024, 2, 9)
    assert before == (spark.conf.get("spark.sql.sources.useV1SourceList"), spark.conf.get("spark.sql.parquet.aggregatePushdown"))


@pytest.mark.parametrize("column,mark", [("load", dt.date(2024, 1, 9)), ("n", 8)])
def test_marks_of_a_table_with_nested_columns(spark, column, mark):
    path = shared_path(spark, "nested-marks")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    spark.range(9).select(F.struct(F.lit(100).cast("long").alias("a"), (F.col("id") + 1000).alias("b")).alias("s"), day.alias("load"),
                          F.col("id").alias("n")).write.parquet(path)
    assert high_water(spark, path, column) == mark
