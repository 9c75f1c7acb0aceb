"""Failing reads, key buckets, the journal of partition moves, the load ledger, change feeds, one-scan tests, VARIANT flatten."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from histmart.operators import flatten_variant
from histmart.operators.quality import Check, DataTest, check_summary, store_failures, summarise
from histmart.plans.feed import odd_feed
from histmart.plans.models import TESTS, build_models, model_checks
from histmart.plans.stg import product_base
from histmart.session import shared_path
from histmart.sources import append, high_water, replace_table, upsert
from histmart.sources.changes import apply_changes, changes
from histmart.sources.files import Folder
from histmart.sources.ledger import Ledger, batch_pipeline, load_once
from histmart.sources.sink import JOURNAL, bucket_column, key_bucket, replace_partitions, table_exists
from histmart.streaming.incremental import land_raw, stream_deduplicated, table_stream

D = dt.date


def rows(spark, path, *cols):
    df = spark.read.parquet(path)
    return sorted((tuple(r) for r in df.select(*(cols or sorted(df.columns))).collect()), key=repr)


# --- a read that fails is no missing table ---

@pytest.mark.parametrize("how", ["listing", "file"])
def test_failed_read_raises_and_leaves_the_table(spark, monkeypatch, how):
    path = shared_path(spark, "t")
    replace_table(spark.range(100).withColumn("d", F.lit(1)).coalesce(1), path, ["d"])
    src = spark.range(3).withColumn("d", F.lit(1))
    if how == "listing":
        def broken(self, child=""):
            raise OSError("the store timed out")
        with monkeypatch.context() as m:
            m.setattr(Folder, "exists", broken)
            for read in (lambda: upsert(spark, src, path, "id", partition_by=["d"]), lambda: high_water(spark, path, "id"),
                         lambda: table_exists(spark, path)):
                with pytest.raises(OSError):
                    read()
        assert spark.read.parquet(path).count() == 100 and high_water(spark, path, "id") == 99
    else:
        local = glob.glob(path.removeprefix("file:") + "/d=1/part-*.parquet")[0]
        with open(local, "rb") as f:
            whole = f.read()
        with open(local, "wb") as f:
            f.write(b"cut short")
        for crc in glob.glob(path.removeprefix("file:") + "/d=1/.part-*.crc"):
            with open(crc, "wb") as f:
                f.write(b"")
        with pytest.raises(Exception):
            upsert(spark, src.withColumn("d", F.lit(1)), path, "id", partition_by=["d"], order=[("d", "desc")])
        with pytest.raises(Exception):
            high_water(spark, path, "id")
        with open(local, "rb") as f:
            assert f.read() == b"cut short" and whole  # the folder is as it was
        assert Folder(spark, path).leaves() == ["d=1"]


def test_missing_and_empty_tables(spark):
    path = shared_path(spark, "none")
    assert not table_exists(spark, path) and high_water(spark, path, "id") == "1900-01-01"
    upsert(spark, spark.range(0), path, "id")
    assert table_exists(spark, path, "id bigint") and spark.read.schema("id bigint").parquet(path).count() == 0
    append(spark.range(3), path)
    assert high_water(spark, path, "id") == 2


# --- key buckets ---

def test_untouched_buckets_keep_their_files(spark):
    path = shared_path(spark, "t")

    def merge(df, asked):
        part, n = bucket_column(spark, path, asked)
        return upsert(spark, df.withColumn(part, key_bucket(["id"], n)), path, "id", partition_by=[part], order=[("v", "desc")],
                      null_keys="match", fixed_partition=True)
    merge(spark.range(500).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), F.lit(1).alias("v")), 16)

    def files():
        return {f.split("/")[-2]: f for f in glob.glob(path.removeprefix("file:") + "/*/part-*")}

    import os
    before = {f: os.stat(f).st_mtime_ns for f in files().values()}
    # another number of buckets asked for: the table's own counts
    done = merge(spark.createDataFrame([(3, 2), (None, 2), (1000, 2)], "id bigint, v int"), 64)
    assert 0 < len(done["partitions"]) <= 3 and all(p.startswith("_bucket16=") for p in done["partitions"])
    after = {f: os.stat(f).st_mtime_ns for f in files().values()}
    kept = {f for f in before if f.split("/")[-2] not in done["partitions"]}
    assert kept and all(after[f] == before[f] for f in kept) and len(files()) == 16
    got = {r["id"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {i: 2 if i in (3, None, 1000) else 1 for i in [*range(7), None, *range(8, 500), 1000]}


# --- the journal ---

@pytest.mark.parametrize("moves", range(7))
def test_moves_go_on_after_a_crash(spark, monkeypatch, moves):
    """Replacing two partitions, adding one and emptying one, ended after any number of moves."""
    path = shared_path(spark, "t")
    schema = "k int, d int"
    replace_table(spark.createDataFrame([(i, i % 4) for i in range(20)], schema), path, ["d"])
    new = spark.createDataFrame([(100, 0), (101, 1), (102, 9)], schema)
    made = []
    move = Folder.move

    def limited(self, *a):
        if len(made) == moves:
            raise KeyboardInterrupt
        made.append(a)
        move(self, *a)
    with monkeypatch.context() as m:
        m.setattr(Folder, "move", limited)
        try:
            replace_partitions(new, path, ["d"], ["d=3"])
        except KeyboardInterrupt:
            assert Folder(spark, path + JOURNAL).exists()
    assert table_exists(spark, path, schema)  # the next access carries out the rest
    want = sorted([(i, 2) for i in range(2, 20, 4)] + [(100, 0), (101, 1), (102, 9)])
    assert sorted(map(tuple, spark.read.schema(schema).parquet(path).collect())) == want
    assert not Folder(spark, path + JOURNAL).exists()
    parent = Folder(spark, path.rsplit("/", 1)[0])
    assert not [x for x in parent.children() if x.startswith(path.rsplit("/", 1)[1] + ".__")]


# --- the ledger ---

def _land(folder, name, *lines):
    import gzip
    import os
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.jsonl.gz", "wt") as f:
        f.write("\n".join(lines))


def test_each_file_is_loaded_once(spark, tmp_dir):
    root, landing = shared_path(spark, "wh"), f"{tmp_dir}/landing"
    loads = []

    def process(lines, load):
        loads.append((load, sorted(r["line"] for r in land_raw(lines, root, load).select("line").collect())))

    def run():
        return load_once(spark, landing, f"{root}/ledger", process, load_date="2024-01-01")
    assert run() == []  # no folder yet
    _land(landing, "a", "1", "2", "")
    _land(f"{landing}/deep/er", "b", "3")
    assert len(run()) == 1 and run() == []
    _land(landing, "c", "4")
    assert len(run()) == 1
    _land(landing, "c", "5", "6")  # the same name with another content is a new file
    assert len(run()) == 1
    with open(f"{landing}/other.txt", "w") as f:
        f.write("7")
    assert run() == []
    assert [x for _, x in loads] == [["1", "2", "3"], ["4"], ["5", "6"]]


def test_interrupted_load_is_finished_with_its_own_files(spark, tmp_dir):
    root, landing = shared_path(spark, "wh"), f"{tmp_dir}/landing"
    _land(landing, "a", "1", "2")

    def broken(lines, load):
        land_raw(lines, root, load)
        raise RuntimeError("executor lost")
    with pytest.raises(RuntimeError):
        load_once(spark, landing, f"{root}/ledger", broken)
    assert Ledger(spark, f"{root}/ledger").open_loads() == ["000000000000"]
    _land(landing, "b", "3")
    assert load_once(spark, landing, f"{root}/ledger", lambda lines, load: land_raw(lines, root, load)) == ["000000000000", "000000000001"]
    got = sorted((r["batch"], r["line"]) for r in spark.read.schema("line string, batch string").parquet(f"{root}/RAW/raw_lines").collect())
    assert got == [("000000000000", "1"), ("000000000000", "2"), ("000000000001", "3")]


def test_batch_pipeline_keeps_raw_rows(spark, tmp_dir):
    root, landing = shared_path(spark, "wh"), f"{tmp_dir}/landing"
    _land(landing, "a", '{"_airbyte_raw_id":"r1","_airbyte_data":{"asin":"A1","title":"t","csv":[[10,5]]}}', '{"cut')
    runs = batch_pipeline(spark, landing, root, load_date="2024-01-01")
    assert [r["rows_loaded"] for r in runs] == [1] and batch_pipeline(spark, landing, root, load_date="2024-01-01") == []
    assert spark.read.parquet(f"{root}/RAW/raw_lines").count() == 2
    assert rows(spark, f"{root}/STG_BAD/raw_bad_lines", "line", "n_lines") == [('{"cut', 1)]
    assert rows(spark, f"{root}/MART/dim_product", "asin") == [("A1",)]


# --- change feed ---

def test_change_feed_rebuilds_the_next_version(spark):
    r = random.Random(4)
    schema = "k int, p string, v double, a array<int>, load int"
    make = lambda: [(k if k else None, r.choice(["x", None]), r.choice([1.0, 2.0, None]), r.choice([[1], [1, None], None]), r.randrange(9))
                    for k in r.sample(range(60), 40)]
    before, after = (spark.createDataFrame(make(), schema) for _ in range(2))
    feed = changes(before, after, "k")
    old, new = ({x["k"]: tuple(x) for x in d.collect()} for d in (before, after))
    want = {k: ("insert", *new[k]) for k in new if k not in old} | {k: ("delete", *old[k]) for k in old if k not in new} | {
        k: ("update", *new[k]) for k in new if k in old and new[k] != old[k]}
    assert sorted(map(repr, map(tuple, feed.collect()))) == sorted(map(repr, want.values()))
    assert sorted(map(repr, map(tuple, apply_changes(before, feed, "k").collect()))) == sorted(map(repr, new.values()))
    stamped = changes(before, before.withColumn("load", F.lit(100)), "k", ignore=["load"])
    assert stamped.count() == 0 and changes(before, before, ["k"]).count() == 0


def test_change_feed_reads_the_touched_partitions(spark):
    path = shared_path(spark, "t")
    first = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2)), (3, "c", None)], "k int, v string, d date")
    replace_table(first, path, ["d"])
    df = spark.read.schema(first.schema).parquet(path)
    after = df.withColumn("v", F.upper("v"))
    feed = changes(df, after, "k", partition="d", touched=[D(2024, 1, 2), None])
    assert sorted((x["change"], x["k"], x["v"]) for x in feed.collect()) == [("update", 2, "B"), ("update", 3, "C")]
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        feed.explain("formatted")
    assert "PartitionFilters: [((d" in out.getvalue()


# --- one-scan tests ---

def test_one_scan_equals_check_by_check(spark):
    """The 35 declared tests over the odd feed, where many of them fail."""
    feed = odd_feed(spark, SF_SMALL).filter("_airbyte_raw_id LIKE 'L1%'")
    path = shared_path(spark, "base")
    base = product_base(feed)
    base.write.parquet(path)
    m = build_models(None, base=spark.read.schema(base.schema).parquet(path))
    tables = {t: m[t] for t in {x.table for x in TESTS} | {x.arg[0] for x in TESTS if x.kind == "relationships"}}
    tables["dim_product"] = tables["dim_product"].filter("asin > 'P15'")
    tables["dim_category"] = tables["dim_category"].union(tables["dim_category"])
    written = {}
    for t, df in tables.items():
        at = shared_path(spark, t)
        replace_table(df, at)
        written[t] = spark.read.schema(df.schema).parquet(at)
    want = sorted(map(tuple, check_summary(spark, model_checks(written)).collect()))
    got = sorted((r["check_name"], r["failures"], r["status"]) for r in summarise(spark, written, TESTS).collect())
    assert got == want and len(got) == 35 and sum(n > 0 for _, n, _ in got) >= 5


def test_one_scan_of_empty_tables(spark):
    empty = spark.createDataFrame([], "a int, b string")
    tests = [DataTest("u", "t", "unique", "a"), DataTest("r", "t", "relationships", "a", ("t", "a")), DataTest("n", "t", "not_null", "b")]
    assert {tuple(r) for r in summarise(spark, {"t": empty}, tests).collect()} == {(x, 0, "pass") for x in "urn"}


def test_stored_failures_follow_the_last_run(spark):
    root = shared_path(spark, "failures")
    df = spark.createDataFrame([(1, -1), (2, -2), (3, 3)], "k int, v int")
    store_failures([Check("a", df.filter("v < 0")), Check("b", df.filter("v > 0"))], root, "one")
    assert rows(spark, f"{root}/a") == [(1, "one", -1), (2, "one", -2)]
    store_failures([Check("b", df.filter("v > 0"))], root, "two", passed=["a", "never"])
    assert rows(spark, f"{root}/a") == [] and rows(spark, f"{root}/b") == [(3, "two", 3)]
    assert not Folder(spark, f"{root}/never").exists()


# --- VARIANT flatten ---

def test_flatten_variant(spark):
    df = spark.createDataFrame([(1, '{"a":[{"x":1},{"x":[5,6]}],"o":{"p":1,"q":null}}'), (2, '{"a":[]}'), (3, "{}"), (4, '{"a":null}'), (5, None), (6, '{"a":3}')],
                               "id int, j string").select("id", F.try_parse_json("j").alias("v"))
    text = lambda c: F.to_json(c)
    inner = flatten_variant(df, "v", "$.a", keep=["id"]).select("id", "index", "key", text("value")).collect()
    assert sorted(map(tuple, inner), key=repr) == [(1, 0, None, '{"x":1}'), (1, 1, None, '{"x":[5,6]}')]
    outer = flatten_variant(df, "v", "$.a", outer=True).collect()
    assert sorted((r["id"], r["index"]) for r in outer if r["id"] > 1) == [(i, None) for i in range(2, 7)]
    fields = flatten_variant(df, "v", "$.o").select("id", "key", text("value")).collect()
    assert sorted(map(tuple, fields)) == [(1, "p", "1"), (1, "q", "null")]
    deep = flatten_variant(flatten_variant(df, "v", "$.a", keep=["id"], out="e").drop("key"), "e", "$.x", outer=True, index="j").select("id", "index", "j", text("value"))
    assert sorted(map(tuple, deep.collect()), key=repr) == [(1, 0, None, None), (1, 1, 0, "5"), (1, 1, 1, "6")]


# --- state-store dedup ---

def test_repeats_within_the_delay_come_once(spark):
    import time
    path = shared_path(spark, "e") + "/e.parquet"
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    files = [[(1, day(1)), (2, day(1)), (1, day(1, 3))], [(2, day(2)), (3, day(9))], [(3, day(9, 5))], [(9, day(1)), (4, None)], [(5, day(20)), (6, day(2))]]
    for f in files:
        spark.createDataFrame(f, "k int, ts timestamp").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.1)
    target = shared_path(spark, "out")
    found = stream_deduplicated(spark, table_stream(spark, path), target, ["k"], "ts", shared_path(spark, "c"), delay="3 days")
    got = sorted((r["k"], r["ts"]) for r in spark.read.parquet(target).collect())
    assert [k for k, _ in got] == [1, 2, 3, 5] and found["late_rows"] == 2
