"""Operator properties: decode forms agree, plans stay skew-safe and pruned."""

import json

from pyspark.sql import functions as F

from conftest import SF_SMALL
from histmart.operators import explode_pairs, flatten, latest_per_key, offset_self_join, text_to_tokens
from histmart.plans.registry import all_queries
from histmart.sources import read_json_array


def test_self_join_decode_equals_in_row_strict(spark):
    df = spark.createDataFrame([(1, "0,a,10,b,20"), (2, "5,x"), (3, ""), (4, '["7","y","8",""]')],
                               "id int, txt string")
    tok = df.select("id", text_to_tokens("txt").alias("t"))
    inrow = explode_pairs(tok, "t", keep=["id"], keep_partial=False, key_name="k", value_name="v")
    flat = flatten(tok, "t", keep=["id"], index="i", value="t")
    joined = offset_self_join(flat, ["id"], idx="i", value="t")
    a = sorted((r.id, r.k, r.v) for r in inrow.collect())
    b = sorted((r.id, r.key_token, r.value_token) for r in joined.collect())
    assert a == b == [(1, "0", "a"), (1, "10", "b"), (2, "5", "x"), (4, "7", "y"), (4, "8", "")]


def test_groupby_decode_equals_in_row_partial(spark):
    q = all_queries()
    a = sorted(tuple(r) for r in q["pair_decode_groupby"](spark, SF_SMALL).select(
        "vec_id", "pair_idx", "k", "v").collect())
    b = sorted(tuple(r) for r in q["pair_decode_full"](spark, SF_SMALL).select(
        "vec_id", "pair_idx", "k", "v").collect())
    assert a == b


def test_json_array_file(spark, tmp_dir):
    path = tmp_dir + "/arr.json"
    with open(path, "w") as f:
        json.dump([{"asin": "A"}, {"asin": "B"}], f)
    assert sorted(r.asin for r in read_json_array(spark, path).collect()) == ["A", "B"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_is_partial_before_shuffle(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(latest_per_key(o, ["o_custkey"], [("o_orderdate", "desc")]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:], plan       # partial top-1 below the shuffle
    assert plan.count("WindowGroupLimit") == 2


def test_series_decode_has_no_shuffle(spark):
    q = all_queries()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(q["text_series_decode"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange" not in plan and "Generate" in plan


def test_model_scan_is_pruned(spark):
    df = all_queries()["stg_aplus_module"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_tax" not in plan
