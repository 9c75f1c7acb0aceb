"""Each library operator run over the driver tables (whole tables, no subsets).

The driver tables do not carry the product feed, so every operator is shown
on a table whose shape fits it; the SQL twin of each query lives in
``plans.oracle``. All callables take (spark, sf_dir) and return a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histmart.functions import (
    in_price_band, json_path, json_text, minutes_to_ts, month_start, nullif_empty, sentinel_flag, sentinel_to_null,
    surrogate_key, try_number, ts_text, ts_to_minutes, variant_path,
)
from histmart.operators import (
    explode_channels, explode_pairs, first_by_value, flatten, full_outer_series, lag_parent,
    last_of_day, latest_per_key, left_enrich_latest, offset_self_join, tagged_assets, text_to_tokens,
)
from histmart.operators.quality import (
    Check, DataTest, Rule, accepted_values, check_summary, expression_is_true, failing_rows, not_null, quarantine,
    quarantine_union, relationships, store_failures, summarise, unique,
)
from histmart.session import shared_path
from histmart.sources.arrays import read_large_json_array
from histmart.sources.changes import changes
from histmart.sources.sink import bucket_column, key_bucket
from histmart.sources import (
    append, create_view, high_water, increment_filter, layer_path, load_status, read_json_array, read_ndjson, table, upsert,
)

# Fixed parameters of the stand-ins.
EVENT_CHANNELS = (("A", 0), ("B", 1), ("C", 2), ("D", 3))
LOAD1_BEFORE = "2024-01-20"   # first load: events before this instant
LOAD2_FROM = "2024-01-10"     # second load: events from this instant (overlaps the first)
LOAD1_DATE = "2024-01-20"
LOAD2_DATE = "2024-01-31"


def _t(spark, sf_dir, name) -> DataFrame:
    return table(spark, sf_dir, name)


# ---- P1: JSON path extraction -------------------------------------------------

def json_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    return ev.select("event_id", json_path("props", "$.k", "bigint").alias("k"))


def variant_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parsed document and its array of values, back as JSON text (F15), and a path of it."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"), F.try_parse_json(
        F.concat(F.lit("["), F.col("event_id"), F.lit(",null]"))).alias("a"))
    return ev.select("event_id", variant_path("v", "$.k", "bigint").alias("k"), json_text("v").alias("doc"), json_text("a").alias("arr"))


# ---- S1-S4, S9: NDJSON bulk load with bad lines --------------------------------

def _write_events_ndjson(spark, sf_dir) -> str:
    """Events as gzip NDJSON under the shared folder; 'error' events add a cut line."""
    ev = _t(spark, sf_dir, "events")
    line = F.to_json(F.struct("event_id", "ts", "user_id", "event_type", "value", "props"),
                     {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    bad = F.when(F.col("event_type") == "error", F.substring(line, 1, 17))
    lines = ev.select(F.explode(F.array_compact(F.array(line, bad))).alias("value"))
    path = shared_path(spark, "ndjson-events")
    lines.write.option("compression", "gzip").text(path)
    return path


NDJSON_TEXT_PATTERN = r"(?i).*\.txt\.gz$"


def ndjson_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_events_ndjson(spark, sf_dir)
    raw, _ = read_ndjson(spark, path, pattern=NDJSON_TEXT_PATTERN, load_date="2024-02-01")
    p = F.col("payload")
    return raw.select(
        F.try_variant_get(p, "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get(p, "$.ts", "timestamp_ntz").alias("ts"),
        F.try_variant_get(p, "$.user_id", "bigint").alias("user_id"),
        F.try_variant_get(p, "$.event_type", "string").alias("event_type"),
        F.try_variant_get(p, "$.value", "double").alias("value"),
        json_path(F.try_variant_get(p, "$.props", "string"), "$.k", "bigint").alias("k"),
        "ingest_dt")


def ndjson_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_events_ndjson(spark, sf_dir)
    _, bad = read_ndjson(spark, path, pattern=NDJSON_TEXT_PATTERN, load_date="2024-02-01")
    return bad.groupBy("reason_code").agg(F.count(F.lit(1)).alias("n_lines"))


# ---- S7, A5: load status --------------------------------------------------------

def load_status_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _t(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("ingest_dt"))
    last_day = raw.select(F.max("ingest_dt")).scalar()
    return load_status(raw, last_day)


# ---- G1, G2: flatten ------------------------------------------------------------

def flatten_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = _t(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return flatten(emb, "embedding", keep=["vec_id"], index="idx", value="value")


def flatten_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers inside each page's title; pages without any keep one NULL row."""
    pages = _t(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract_all(F.col("html"), F.lit("<title>([^<]*)</title>"), 1).alias("t"))
    nums = pages.select("page_id", F.regexp_extract_all(F.concat_ws(" ", "t"), F.lit("[0-9]+"), 0)
                        .alias("nums"))
    return flatten(nums, "nums", keep=["page_id"], outer=True, index="idx", value="token")


# ---- G3, U2: chained outer flatten into one tagged asset table --------------------

ASSET_KINDS = (("word", "words", "token"), ("number", "numbers", "token"))


def flatten_nested_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = _t(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.split(F.col("text"), "\n", -1).alias("lines"))
    lines = flatten(conv, "lines", keep=["conv_id", "turn", "role"], outer=True,
                    index="line_idx", value="line")
    mod = F.struct(F.split(F.col("line"), " ", -1).alias("words"),
                   F.regexp_extract_all(F.col("line"), F.lit("[0-9]+"), 0).alias("numbers"))
    return lines.select("conv_id", "turn", "role", "line_idx",
                        F.inline(tagged_assets(mod, ASSET_KINDS)))


# ---- G6, G7: pair decode ----------------------------------------------------------

def _positive_components(spark, sf_dir):
    emb = _t(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.filter("embedding", lambda x: x > 0).alias("arr"))


def pair_decode_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_pairs(_positive_components(spark, sf_dir), "arr", keep=["vec_id"],
                         keep_partial=True, key_name="k", value_name="v")


def pair_decode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_pairs(_positive_components(spark, sf_dir), "arr", keep=["vec_id"],
                         keep_partial=False, key_name="k", value_name="v")


def pair_decode_groupby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flatten + group-by form (A1, A6): conditional max per floor(index/2).

    Same result as ``pair_decode_full``; it shuffles, the in-row decode does not.
    """
    f = flatten(_positive_components(spark, sf_dir), "arr", keep=["vec_id"], index="i", value="x")
    return (f.groupBy("vec_id", F.floor(F.col("i") / 2).cast("int").alias("pair_idx"))
            .agg(F.max(F.when(F.col("i") % 2 == 0, F.col("x"))).alias("k"),
                 F.max(F.when(F.col("i") % 2 == 1, F.col("x"))).alias("v")))


# ---- G5, G8: named channels of an array of arrays -----------------------------------

def channel_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector in four channels of a quarter of its length (the last takes the rest)."""
    n = F.floor(F.size("embedding") / 4).cast("int")
    parts = [F.slice("embedding", n * i + 1, n if i < 3 else F.size("embedding") - 3 * n) for i in range(4)]
    emb = _t(spark, sf_dir, "embeddings").select("vec_id", F.array(*parts).alias("csv"))
    return explode_channels(emb, "csv", EVENT_CHANNELS, keep=["vec_id"], keep_partial=False,
                            name="channel", key_name="k", value_name="v")


# ---- G4, F12, F13: comma-text series --------------------------------------------------

def _line_series_text(li: DataFrame) -> DataFrame:
    """Per line item: 'minute,partkey,minute+line,suppkey,status,orderkey,quantity'.

    Odd line numbers ship the same tokens as a JSON array text instead.
    """
    minute = ts_to_minutes("l_shipdate")
    toks = F.array(minute.cast("string"), F.col("l_partkey").cast("string"),
                   (minute + F.col("l_linenumber")).cast("string"), F.col("l_suppkey").cast("string"),
                   F.col("l_linestatus"), F.col("l_orderkey").cast("string"),
                   F.col("l_quantity").cast("string"))
    text = F.when(F.col("l_linenumber") % 2 == 1, F.to_json(toks)).otherwise(F.array_join(toks, ","))
    return li.select("l_orderkey", "l_linenumber", text.alias("series_text"))


def text_series_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _line_series_text(_t(spark, sf_dir, "lineitem"))
    pts = explode_pairs(li.select("l_orderkey", "l_linenumber", text_to_tokens("series_text").alias("tok")),
                        "tok", keep=["l_orderkey", "l_linenumber"], keep_partial=False,
                        key_name="k", value_name="v")
    return pts.select("l_orderkey", "l_linenumber", "pair_idx",
                      minutes_to_ts(try_number("k")).alias("snapshot_ts"),
                      try_number("v").alias("value"))


# ---- F7-F10: minutes since 2011 -----------------------------------------------------

def minutes_to_ts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    m = ts_to_minutes("ts")
    return ev.select("event_id", m.alias("minutes"), minutes_to_ts(m).alias("ts_minute"),
                     month_start(minutes_to_ts(m)).alias("month"),
                     minutes_to_ts(m).cast("date").alias("day"))


# ---- P12, P10: sentinels and price band ----------------------------------------------

def sentinel_to_null_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", sentinel_to_null("c_acctbal", None, "decimal(18,2)").alias("acctbal"),
                    sentinel_flag("c_acctbal").alias("was_sentinel"))


def price_band_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.filter(in_price_band("c_acctbal")).select("c_custkey", "c_acctbal")


# ---- J2: full outer series -------------------------------------------------------------

def full_outer_series_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = _t(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return full_outer_series(docs, labels, ["doc_id"])


# ---- J3, P16: left join to the newest dimension row -------------------------------------

def left_enrich_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    orders = _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus", "o_orderdate",
        "o_totalprice")
    return left_enrich_latest(li, orders, ["l_orderkey"], [("o_orderdate", "desc")],
                              tie_break=[("o_totalprice", "desc")],
                              dim_cols=["o_custkey", "o_orderstatus"])


# ---- W1-W4 -----------------------------------------------------------------------------

def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    return latest_per_key(o, ["o_custkey"], [("o_orderdate", "desc")], tie_break=[("o_orderkey", "desc")])


def _events_as_loads(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.withColumn("ingest_ts", F.col("ts").cast("date"))


def last_of_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events_as_loads(spark, sf_dir)
    d = last_of_day(ev, ["user_id", "event_type"], "ts", tie_break=[("event_id", "desc")])
    return d.select("user_id", "event_type", "date", "event_id", "ts", "value")


def first_by_value_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events").withColumn("date", F.col("ts").cast("date"))
    return first_by_value(ev.select("user_id", "date", "event_type"), ["user_id", "date"], ["event_type"])


def offset_self_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The self-join form of the strict pair decode (J1); the library decodes pairs in the row."""
    toks = flatten(_positive_components(spark, sf_dir), "arr", keep=["vec_id"], index="i", value="t")
    return offset_self_join(toks, ["vec_id"]).select(
        "vec_id", F.floor(F.col("pair_start") / 2).cast("int").alias("pair_idx"),
        F.col("key_token").alias("k"), F.col("value_token").alias("v"))


def lag_parent_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous line item of each supplier: groups that grow with the data."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").distinct()
    return lag_parent(li, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], "l_orderkey", out="previous_order")


def load_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage columns of a raw load (S9), and each load stamp pinned (F16)."""
    raw, _ = read_ndjson(spark, _write_events_ndjson(spark, sf_dir), pattern=NDJSON_TEXT_PATTERN, load_date="2024-02-01")
    return raw.groupBy("ingest_dt").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("file_name").endswith(".txt.gz")).alias("n_named"),
        F.count_if(F.col("file_path").contains(F.col("file_name"))).alias("n_paths"),
        F.count_if(F.col("file_modified") <= F.current_timestamp()).alias("n_dated"))


ARRAY_KEYS = 20_000  # customer keys that an array's customers are taken from
ARRAY_ORDERS = 10_000_000  # order keys that a file's line items are taken from


def json_array_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files holding one outer array (S5): a nation's customers, one array per range of customer keys."""
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", F.floor(F.col("c_custkey") / ARRAY_KEYS).alias("range"))
    path = shared_path(spark, "json-arrays")
    arrays = cust.groupBy("c_nationkey", "range").agg(F.sort_array(F.collect_list(F.struct("c_custkey", "c_name"))).alias("rows"))
    arrays.select(F.to_json("rows").alias("value"), "c_nationkey", "range").repartition("c_nationkey", "range").write.partitionBy(
        "c_nationkey", "range").text(path)
    return read_json_array(spark, path, "c_custkey bigint, c_name string, c_nationkey int").select("c_custkey", "c_name", "c_nationkey")


def json_array_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with one outer array for each nation (and range of order keys), read by many tasks (S5): line items of the
    nation's suppliers."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag")
    rows = li.join(_t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey", "s_name"), "l_suppkey")
    rows = rows.withColumn("range", F.floor(F.col("l_orderkey") / ARRAY_ORDERS))
    path = shared_path(spark, "json-large-arrays")
    # a file is written row by row in its order; no row holds a group
    files, order = ["s_nationkey", "range"], ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_returnflag"]
    w = Window.partitionBy(*files).orderBy(*order)
    field = F.to_json(F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", F.struct("s_name", F.array("l_returnflag").alias(
        "flags")).alias("of")))
    at = rows.withColumn("i", F.row_number().over(w)).withColumn("more", F.lead(F.lit(1)).over(w))
    value = F.concat(F.when(F.col("i") == 1, "[").otherwise(","), field, F.when(F.col("more").isNull(), "]").otherwise(""))
    at.sortWithinPartitions(*files, *order, "i").select(*files, value.alias("value")).write.partitionBy(*files).text(path)
    read = read_large_json_array(spark, path, "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_extendedprice double, "
                                              "of struct<s_name string, flags array<string>>")
    return read.select("s_nationkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", F.col("of.s_name").alias("s_name"),
                       F.element_at("of.flags", 1).alias("flag"))


def stored_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A singular check (D12) whose failing rows are stored (D13) under the routed layer."""
    root = shared_path(spark, "stored")
    path = layer_path(root, "monitoring", "test_failures")
    store_failures([Check("negative_balance", failing_rows(_t(spark, sf_dir, "customer"), "c_acctbal < 0"))], path)
    return spark.read.parquet(f"{root}/MONITORING/test_failures/negative_balance").select("c_custkey", "c_acctbal")


def stored_failures_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of two checks: the stored rows are those of the last run, and of a check that passes again none."""
    path = layer_path(shared_path(spark, "stored"), "monitoring", "test_failures")
    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    negative = Check("negative_balance", failing_rows(cust, "c_acctbal < 0"))
    far = Check("far_nation", failing_rows(cust, "c_nationkey > 20"))
    store_failures([negative, far], path, "run-1")
    store_failures([negative], path, "run-2", passed=["far_nation"])
    parts = [spark.read.parquet(f"{path}/{n}").select(F.lit(n).alias("check_name"), "run_id", "c_custkey") for n in ("negative_balance", "far_nation")]
    return parts[0].unionByName(parts[1])


def _tests() -> list[DataTest]:
    """Tests of every kind, several to a table, some of which fail."""
    return [
        DataTest("orders_key_unique", "orders", "unique", "o_orderkey"), DataTest("orders_customer_unique", "orders", "unique", "o_custkey"),
        DataTest("orders_status_values", "orders", "accepted_values", "o_orderstatus", ("F", "O")),
        DataTest("orders_customer", "orders", "relationships", "o_custkey", ("customer", "c_custkey")),
        DataTest("lineitem_order", "lineitem", "relationships", "l_orderkey", ("orders", "o_orderkey")),
        DataTest("lineitem_discount", "lineitem", "expression", arg="l_discount <= 0.08"),
        DataTest("lineitem_negative_price", "lineitem", "failing", arg="l_extendedprice < 0"),
        DataTest("events_type", "events", "not_null", "event_type"), DataTest("events_user", "events", "not_null", "user_id"),
        DataTest("documents_label", "documents", "relationships", "doc_id", ("labels", "doc_id")),
        DataTest("customer_balance", "customer", "failing", arg="c_acctbal < 0"),
    ]


def checks_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tests of six tables summed from one scan of each."""
    tables = {t: _t(spark, sf_dir, t) for t in ("orders", "customer", "lineitem", "documents", "labels")}
    return summarise(spark, tables | {"events": _keyed_events(spark, sf_dir)}, _tests())


# ---- S4, S1: a batch load that takes each file once -------------------------------------------

def load_once_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batch loads of a folder: the second finds the files of the first again and two new ones."""
    from histmart.sources.ledger import load_once
    from histmart.streaming.incremental import land_raw
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type", F.to_json(F.struct("event_id", "event_type", "value")).alias("line"))
    landing, root = shared_path(spark, "landing"), shared_path(spark, "load-once")
    late = F.col("event_type").isin("purchase", "error")
    for part in (~late, late):
        ev.filter(part).select("line", "event_type").write.mode("append").partitionBy("event_type").option("compression", "gzip").text(landing)
        for _ in range(2):  # the second call has nothing to load
            load_once(spark, landing, f"{root}/ledger", lambda lines, load: land_raw(lines, root, load), NDJSON_TEXT_PATTERN, "2024-02-01")
    raw = spark.read.parquet(layer_path(root, "raw", "raw_lines")).withColumn("p", F.try_parse_json("line"))
    return raw.select(F.col("batch").cast("int").alias("load"), variant_path("p", "$.event_id", "bigint").alias("event_id"),
                      variant_path("p", "$.value", "double").alias("value"), "ingest_dt")


# ---- S12, S8: key buckets and the change feed ---------------------------------------------------

def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads merged into a table without a time in its key, by hash buckets of the key."""
    l1, l2 = _raw_loads(spark, sf_dir)
    target = shared_path(spark, "upsert-bucketed")
    for load in (l1, l2, l1):
        part, n = bucket_column(spark, target, 8)
        upsert(spark, load.withColumn(part, key_bucket(["event_id"], n)), target, "event_id", partition_by=[part],
               order=[("ingest_ts", "desc"), ("value", "desc")], fixed_partition=True)
    return spark.read.parquet(target).select("event_id", "ts", "user_id", "event_type", "value", "ingest_ts")


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a second load inserts, updates and deletes; its load stamp alone is no change."""
    l1, l2 = _raw_loads(spark, sf_dir)
    after = l1.filter("event_id % 9 <> 0").join(l2.select("event_id"), "event_id", "left_anti").unionByName(
        l2.withColumn("value", F.when(F.col("event_id") % 4 == 0, F.col("value") / 2).otherwise(F.col("value"))))
    return changes(l1, after, "event_id", ignore=["ingest_ts"])


def strict_event_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append with the strict mark on the event date (S16): the boundary day is not taken again."""
    l1, l2 = _raw_loads(spark, sf_dir)
    target = shared_path(spark, "strict-events")
    for load in (l1, l2):
        mark = high_water(spark, target, "ts", as_date=True)
        append(load.filter(increment_filter("ts", mark, "strict", as_date=True)), target)
    return spark.read.parquet(target).select("event_id", "ts", "value", "ingest_ts")


def lag_parent_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _t(spark, sf_dir, "nation")
    return lag_parent(n, ["n_regionkey"], ["n_nationkey"], "n_nationkey", out="parent_nationkey")


def monthly_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").withColumn("order_month", month_start("o_orderdate"))
    d = latest_per_key(o, ["o_custkey", "order_month"], [("o_orderdate", "desc")],
                       tie_break=[("o_orderkey", "desc")])
    return d.select("o_custkey", "order_month", "o_orderkey", "o_totalprice")


# ---- A4, F1: dimensions and bridges ------------------------------------------------------

def dim_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select("p_brand", "p_type").distinct()


def dim_seller_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_suppkey").isNotNull()).select("l_suppkey").distinct()


def bridge_product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return li.select(surrogate_key("l_partkey", "l_suppkey").alias("pk"), "l_partkey", "l_suppkey")


def surrogate_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    return o.select(
        "o_orderkey",
        surrogate_key("o_orderkey", "o_custkey", ts_text("o_orderdate")).alias("key_plain"),
        surrogate_key("o_orderkey", "status").alias("key_nullable"),
        surrogate_key("o_orderkey", "status", null_token="NULL").alias("key_token"))


def fact_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    src = ev.filter(F.col("value").isNotNull() & (F.col("value") >= 0))
    pk = F.md5(F.concat(F.col("event_id").cast("string"), F.lit("|"),
                        F.col("ts").cast("date").cast("string"), F.lit("|EVENT_VALUE_DAILY")))
    return src.select(pk.alias("pk"), "event_id", "user_id", "value")


# ---- S12-S16: incremental upsert and append ------------------------------------------------

def _raw_loads(spark, sf_dir):
    """Two overlapping loads of events (second one re-states values x2)."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    l1 = ev.filter(F.col("ts") < F.lit(LOAD1_BEFORE).cast("timestamp_ntz")).withColumn(
        "ingest_ts", F.lit(LOAD1_DATE).cast("date"))
    l2 = (ev.filter(F.col("ts") >= F.lit(LOAD2_FROM).cast("timestamp_ntz"))
          .withColumn("value", F.col("value") * 2)
          .withColumn("ingest_ts", F.lit(LOAD2_DATE).cast("date")))
    return l1, l2


def upsert_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW grows by two loads; each run takes rows past the target's strict mark."""
    l1, l2 = _raw_loads(spark, sf_dir)
    raw_path = shared_path(spark, "raw-events")
    target = shared_path(spark, "upsert-events")
    l1.write.parquet(raw_path)
    for load in (None, l2):
        if load is not None:
            load.write.mode("append").parquet(raw_path)
        mark = high_water(spark, target, "ingest_ts")
        raw = spark.read.parquet(raw_path)
        inc = raw.filter(increment_filter("ingest_ts", mark, "strict", as_date=True))
        inc = inc.withColumn("date", F.col("ts").cast("date"))
        upsert(spark, inc, target, "event_id", partition_by=["date"],
               order=[("ingest_ts", "desc")])
    return spark.read.parquet(target).select("event_id", "ts", "user_id", "event_type", "value",
                                             "ingest_ts")


def upsert_late_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newer load first, then the older one: an old row never replaces a newer one."""
    l1, l2 = _raw_loads(spark, sf_dir)
    target = shared_path(spark, "upsert-late")
    for load in (l2, l1, l2):
        upsert(spark, load.withColumn("date", F.col("ts").cast("date")), target, "event_id", partition_by=["date"],
               order=[("ingest_ts", "desc"), ("value", "desc")])
    return spark.read.parquet(target).select("event_id", "ts", "user_id", "event_type", "value", "ingest_ts")


def _keyed_events(spark, sf_dir) -> DataFrame:
    """Events keyed by (user, type) with NULLs: no type for errors, no user for every tenth."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return (ev.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))
            .withColumn("user_id", F.when(F.col("event_id") % 10 != 0, F.col("user_id"))))


def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a MERGE on (user, type) could never match: set aside once each, however often they come."""
    ev, target = _keyed_events(spark, sf_dir), shared_path(spark, "upsert-null")
    for _ in range(2):
        upsert(spark, ev, target, ["user_id", "event_type"], order=[("ts", "desc"), ("event_id", "desc")])
    return spark.read.parquet(f"{target}__null_keys")


def upsert_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with NULL as a value of the key: one row per (user, type), NULL parts included."""
    ev, target = _keyed_events(spark, sf_dir), shared_path(spark, "upsert-null-safe")
    for part in (F.col("event_id") % 2 == 0, F.col("event_id") % 2 == 1):
        upsert(spark, ev.filter(part), target, ["user_id", "event_type"], order=[("ts", "desc"), ("event_id", "desc")], null_keys="match")
    return spark.read.parquet(target)


def full_refresh_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh leaves no partition of the table before."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "value").withColumn("date", F.col("ts").cast("date"))
    target = shared_path(spark, "full-refresh")
    upsert(spark, ev, target, "event_id", partition_by=["date"])
    upsert(spark, ev.filter(F.dayofmonth("date") <= 5), target, "event_id", partition_by=["date"], full_refresh=True)
    return spark.read.parquet(target).select("event_id", "ts", "value", "date")


def upsert_moved_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys whose partition changes leave their old one, also when that empties it."""
    ev = _t(spark, sf_dir, "events").select("event_id", "value", F.col("ts").cast("date").alias("date"))
    target = shared_path(spark, "upsert-moved")
    upsert(spark, ev, target, "event_id", partition_by=["date"])
    moved = ev.filter((F.dayofmonth("date") == 7) | (F.col("event_id") % 50 == 0)).withColumn("date", F.date_add("date", 400))
    upsert(spark, moved, target, "event_id", partition_by=["date"])
    return spark.read.parquet(target).select("event_id", "value", "date")


def append_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only target with an inclusive event-day mark: the boundary day repeats."""
    l1, l2 = _raw_loads(spark, sf_dir)
    target = shared_path(spark, "append-events")
    for load in (l1, l2):
        mark = high_water(spark, target, "ts", as_date=True)
        inc = load.filter(increment_filter("ts", mark, "inclusive", as_date=True))
        append(inc, target)
    return spark.read.parquet(target).select("event_id", "ts", "value", "ingest_ts")


# ---- D1-D6: quarantines -------------------------------------------------------------------

def _lineitem_quarantine(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    rules = [Rule("DISCOUNT_HIGH", F.col("l_discount") > 0.08),
             Rule("TAX_ZERO", F.col("l_tax") == 0),
             Rule("RETURNED", F.col("l_returnflag") == "R")]
    return quarantine(li, rules, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                      "line item rule failure",
                      keep=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = _lineitem_quarantine(spark, sf_dir)
    return bad


def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = _lineitem_quarantine(spark, sf_dir)
    return good.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax")


def quarantine_union_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, li_bad = _lineitem_quarantine(spark, sf_dir)
    cust = _t(spark, sf_dir, "customer")
    _, cust_bad = quarantine(cust, [Rule("BALANCE_NEGATIVE", F.col("c_acctbal") < 0)],
                             ["c_custkey"], "customer rule failure", keep=["c_custkey"])
    lab = _t(spark, sf_dir, "labels")
    _, lab_bad = quarantine(lab, [Rule("TOXIC", F.col("toxic") == 1),
                                  Rule("LOW_QUALITY", F.col("quality") == 0)],
                            ["doc_id"], "label rule failure", keep=["doc_id"])
    parts = [("lineitem", li_bad.withColumn("entity_key", F.col("l_orderkey").cast("string"))),
             ("customer", cust_bad.withColumn("entity_key", F.col("c_custkey").cast("string"))),
             ("labels", lab_bad.withColumn("entity_key", F.col("doc_id").cast("string")))]
    return quarantine_union(parts, columns=("bad_row_id", "entity_key", "reason_code",
                                            "reason_detail", "l_linenumber"),
                            types={"l_linenumber": "int"})


# ---- D7-D12, S18, D13: checks and run metrics ---------------------------------------------

def _checks(spark, sf_dir) -> list[Check]:
    li = _t(spark, sf_dir, "lineitem")
    orders = _t(spark, sf_dir, "orders")
    docs = _t(spark, sf_dir, "documents")
    labels = _t(spark, sf_dir, "labels")
    status = orders.select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    keyed = li.select(F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                  F.col("l_linenumber").cast("string")).alias("line_key"))
    return [
        Check("check_not_null", not_null(status, "status")),
        Check("check_unique", unique(keyed, "line_key")),
        Check("check_accepted_values", accepted_values(orders, "o_orderstatus", ["F", "O"])),
        Check("check_relationships", relationships(docs, "doc_id", labels, "doc_id")),
        Check("check_expression", expression_is_true(li, "l_discount <= 0.08")),
    ]


def check_not_null(spark, sf_dir):
    return _checks(spark, sf_dir)[0].failures


def check_unique(spark, sf_dir):
    return _checks(spark, sf_dir)[1].failures


def check_accepted_values(spark, sf_dir):
    return _checks(spark, sf_dir)[2].failures.select("o_orderkey", "o_orderstatus")


def check_relationships(spark, sf_dir):
    return _checks(spark, sf_dir)[3].failures.select("doc_id")


def check_expression(spark, sf_dir):
    return _checks(spark, sf_dir)[4].failures.select("l_orderkey", "l_linenumber", "l_discount")


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_summary(spark, _checks(spark, sf_dir))


def run_monitoring_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitoring row of a run (S18), logged twice under one run id and kept once."""
    from histmart.plans.pipeline import MONITORING_TABLE, log_run
    summary = check_summary(spark, _checks(spark, sf_dir)).collect()  # one row per check
    failed = sum(r["failures"] > 0 for r in summary)
    root = shared_path(spark, "monitoring")
    for _ in range(2):
        log_run(spark, root, {"run_id": "run-1", "status": "success_with_warnings" if failed else "success", "models_run": 0,
                              "tests_passed": len(summary) - failed, "tests_failed": failed,
                              "rows_loaded": _t(spark, sf_dir, "lineitem").count()})
    return spark.read.parquet(layer_path(root, "monitoring", MONITORING_TABLE)).select(
        "dag_id", "run_id", "status", "tests_passed", "tests_failed", "rows_loaded_raw")


def view_materialised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model published as a view (S11): read by name, nothing written."""
    create_view(_t(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey", "c_acctbal"), "negative_balances")
    return spark.table("negative_balances")


def empty_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose text is neither NULL nor empty (P9); errors have an empty type here."""
    ev = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("t"))
    return ev.filter(nullif_empty("t").isNotNull())


# ---- T4: late rows dropped, repeats dropped in the state store ------------------------------------

def _ordered_files(spark, sf_dir, again: int) -> str:
    """Events as a table of files in the order of time; every ``again``-th part comes a second time as the last file."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    path = shared_path(spark, "ordered-events") + "/events.parquet"
    first = ev.select(F.min("ts")).scalar()
    part = F.floor(F.datediff("ts", F.lit(first)) / 5)
    last = ev.select(F.max(part)).first()[0]
    for i in range(last + 1):
        ev.filter(part == i).coalesce(1).write.mode("append").parquet(path)
    ev.filter(part % again == 0).coalesce(1).write.mode("append").parquet(path)
    return path


def stream_windowed_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last of day by a stateful window with a watermark: a file of old rows at the end changes nothing (T4, policy drop)."""
    from histmart.streaming.incremental import stream_windowed_latest, table_stream
    target = shared_path(spark, "stream-drop")
    stream_windowed_latest(spark, table_stream(spark, _ordered_files(spark, sf_dir, 2)), target, ["user_id", "event_type"], "ts",
                           ["event_id", "ts", "value"], "event_id", checkpoint=shared_path(spark, "stream-drop-ckpt"), late="drop")
    return spark.read.parquet(target).select("user_id", "event_type", "date", "event_id", "ts", "value")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which many come twice, once each by state-store dedup within the watermark (T4)."""
    from histmart.streaming.incremental import stream_deduplicated, table_stream
    target = shared_path(spark, "stream-dedup")
    stream_deduplicated(spark, table_stream(spark, _ordered_files(spark, sf_dir, 1)), target, ["event_id"], "ts",
                        checkpoint=shared_path(spark, "stream-dedup-ckpt"), delay="60 days")
    return spark.read.parquet(target)


# ---- T1, T3, T4: the last-of-day table maintained by a stream -------------------------------

def stream_last_of_day_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> file-source stream (availableNow) -> foreachBatch last-of-day upsert."""
    from histmart.streaming.incremental import stream_last_of_day, table_stream
    stream = table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet").withColumn("ingest_ts", F.col("ts").cast("date"))
    target = shared_path(spark, "stream-last-of-day")
    stream_last_of_day(spark, stream, target, ["user_id", "event_type"], "ts", "ingest_ts",
                       checkpoint=shared_path(spark, "stream-ckpt"), tie_break=[("event_id", "desc")])
    return spark.read.parquet(target).select("user_id", "event_type", "date", "event_id", "ts", "value")


def stream_windowed_last_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> tumbling day window + max_by per micro-batch -> ordered upsert (late rows merge)."""
    from histmart.streaming.incremental import stream_windowed_latest, table_stream
    target = shared_path(spark, "stream-windowed")
    stream_windowed_latest(spark, table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet"), target,
                           ["user_id", "event_type"], "ts", ["event_id", "ts", "value"], "event_id",
                           checkpoint=shared_path(spark, "stream-window-ckpt"))
    return spark.read.parquet(target).select("user_id", "event_type", "date", "event_id", "ts", "value")
