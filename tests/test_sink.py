"""Tables in place: ordered and NULL-safe upserts, moved partitions, replacement by rename, streams in any file order."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from histmart.operators.dedup import lag_parent, last_of_day
from histmart.session import checkpoint_root, is_local, shared_path
from histmart.sources import replace_table, upsert
from histmart.sources.files import Folder
from histmart.streaming.incremental import land_raw, stream_last_of_day, stream_windowed_latest, table_stream

D = dt.date
SCHEMA = "k int, v string, load int, d date"


def rows(spark, path, *cols):
    df = spark.read.parquet(path)
    return sorted((tuple(r) for r in df.select(*(cols or sorted(df.columns))).collect()), key=repr)


@pytest.mark.parametrize("loads", [(1, 2, 3), (3, 2, 1), (2, 3, 1, 2), (3, 3)])
def test_old_load_never_beats_a_newer_row(spark, loads):
    path = shared_path(spark, "t")
    for n in loads:
        src = spark.createDataFrame([(1, f"v{n}", n, D(2024, 1, 1)), (10 + n, "own", n, D(2024, 1, n))], SCHEMA)
        upsert(spark, src, path, "k", partition_by=["d"], order=[("load", "desc"), ("v", "desc")])
    assert rows(spark, path, "k", "v") == sorted([(1, f"v{max(loads)}"), *((10 + n, "own") for n in set(loads))], key=repr)


def test_null_keys_are_set_aside_once_or_matched(spark):
    src = spark.createDataFrame([(None, "a", 1, D(2024, 1, 1)), (None, "a", 1, D(2024, 1, 1)), (1, None, 1, D(2024, 1, 1)), (1, "b", 1, D(2024, 1, 2))], SCHEMA)
    path = shared_path(spark, "t")
    for _ in range(2):
        result = upsert(spark, src, path, ["k", "v"], order=[("load", "desc")])
        assert result["null_keys"] == 3
    assert rows(spark, path, "k", "v") == [(1, "b")]
    assert rows(spark, path + "__null_keys", "k", "v") == [(1, None), (None, "a")]
    path = shared_path(spark, "t")
    for _ in range(2):
        upsert(spark, src, path, ["k", "v"], order=[("load", "desc")], null_keys="match")
    assert rows(spark, path, "k", "v") == [(1, "b"), (1, None), (None, "a")]


def test_full_refresh_leaves_no_old_partition(spark):
    path = shared_path(spark, "t")
    upsert(spark, spark.createDataFrame([(1, "a", 1, D(2024, 1, 1)), (2, "b", 1, D(2024, 1, 2))], SCHEMA), path, "k", partition_by=["d"])
    upsert(spark, spark.createDataFrame([(9, "z", 2, D(2024, 1, 9))], SCHEMA), path, "k", partition_by=["d"], full_refresh=True)
    assert rows(spark, path, "k") == [(9,)]
    upsert(spark, spark.createDataFrame([], SCHEMA), path, "k", partition_by=["d"], full_refresh=True)
    assert spark.read.schema(SCHEMA).parquet(path).count() == 0


def test_key_that_changes_partition_moves(spark):
    path = shared_path(spark, "t")
    first = spark.createDataFrame([(1, "a", 1, D(2024, 1, 1)), (2, "b", 1, D(2024, 1, 2)), (3, "c", 1, D(2024, 1, 2)), (4, "n", 1, None)], SCHEMA)
    upsert(spark, first, path, "k", partition_by=["d"], order=[("load", "desc")])
    moved = spark.createDataFrame([(1, "A", 2, D(2024, 1, 5)), (2, "B", 2, D(2024, 1, 1)), (4, "N", 2, D(2024, 1, 7)), (3, "old", 0, D(2024, 1, 8))], SCHEMA)
    upsert(spark, moved, path, "k", partition_by=["d"], order=[("load", "desc")])
    assert rows(spark, path, "k", "v") == [(1, "A"), (2, "B"), (3, "c"), (4, "N")]
    assert sorted(Folder(spark, path).leaves()) == ["d=2024-01-01", "d=2024-01-02", "d=2024-01-05", "d=2024-01-07"]


def test_untouched_partitions_are_not_rewritten(spark):
    path = shared_path(spark, "t")
    upsert(spark, spark.createDataFrame([(1, "a", 1, D(2024, 1, 1)), (2, "b", 1, D(2024, 1, 2))], SCHEMA), path, ["k", "d"], partition_by=["d"])
    before = {r[0] for r in spark.read.parquet(path).filter("k = 1").select("_metadata.file_path").collect()}
    upsert(spark, spark.createDataFrame([(3, "c", 1, D(2024, 1, 2))], SCHEMA), path, ["k", "d"], partition_by=["d"])
    assert {r[0] for r in spark.read.parquet(path).filter("k = 1").select("_metadata.file_path").collect()} == before
    assert rows(spark, path, "k") == [(1,), (2,), (3,)]


def test_table_comes_back_after_a_crash_between_renames(spark):
    path = shared_path(spark, "t")
    replace_table(spark.range(3), path)
    Folder(spark, path).move("", Folder(spark, path + ".__old"), "")  # as if the run had ended here
    upsert(spark, spark.range(2, 5), path, "id", order=[("id", "desc")])
    assert rows(spark, path) == [(0,), (1,), (2,), (3,), (4,)]
    assert not Folder(spark, path + ".__old").exists()


def test_partition_values_with_special_characters(spark):
    path = shared_path(spark, "t")
    first = spark.createDataFrame([(1, "a b:c/d%", 1, None), (2, "", 1, None), (3, None, 1, None)], SCHEMA)
    upsert(spark, first, path, "k", partition_by=["v"], order=[("load", "desc")])
    upsert(spark, spark.createDataFrame([(1, "x", 2, None)], SCHEMA), path, "k", partition_by=["v"], order=[("load", "desc")])
    assert [r[0] for r in rows(spark, path, "k")] == [1, 2, 3]
    assert len(Folder(spark, path).leaves()) == 2


def test_cluster_without_shared_folder_is_an_error(spark):
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[2,1,1024]") and not is_local("spark://x:1")

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)
    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


@pytest.fixture(scope="module")
def event_files(spark):
    """Events with NULL keys as a table of four files; the file names sort newest first."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error"))).withColumn(
        "user_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id"))).orderBy("ts")
    path = shared_path(spark, "events") + "/events.parquet"
    ordered = ev.collect()
    n = len(ordered)
    for i in range(4):
        part = ordered[n * (3 - i) // 4: n * (4 - i) // 4]
        spark.createDataFrame(part, ev.schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # file sources take files by modification time
    return path, ev


def test_streams_do_not_depend_on_file_order(spark, event_files):
    path, ev = event_files
    keys = ["user_id", "event_type"]
    want = last_of_day(ev.withColumn("ingest_ts", F.col("ts").cast("date")), keys, "ts", tie_break=[("event_id", "desc")])
    cols = [*keys, "date", "event_id", "ts", "value"]
    want = sorted((tuple(r) for r in want.select(*cols).collect()), key=repr)
    a, b = shared_path(spark, "s1"), shared_path(spark, "s2")
    stream_last_of_day(spark, table_stream(spark, path).withColumn("ingest_ts", F.col("ts").cast("date")), a, keys, "ts", "ingest_ts",
                       checkpoint=shared_path(spark, "c1"), tie_break=[("event_id", "desc")])
    assert rows(spark, a, *cols) == want
    result = stream_windowed_latest(spark, table_stream(spark, path), b, keys, "ts", ["event_id", "ts", "value"], "event_id",
                                    checkpoint=shared_path(spark, "c2"))
    assert rows(spark, b, *cols) == want and result == {"late_rows": 0}


def test_dropped_late_rows_are_counted(spark, event_files):
    path, ev = event_files
    target = shared_path(spark, "s3")
    result = stream_windowed_latest(spark, table_stream(spark, path), target, ["user_id", "event_type"], "ts", ["event_id", "ts", "value"],
                                    "event_id", checkpoint=shared_path(spark, "c3"), late="drop")
    assert result["late_rows"] > 0 and spark.read.parquet(target).count() < ev.select("user_id", "event_type", F.col("ts").cast("date")).distinct().count()


def test_replayed_raw_batch_replaces_its_partition(spark):
    root = shared_path(spark, "wh")
    lines = spark.createDataFrame([("x", 1), ("y", 2)], "line string, n int")
    land_raw(lines, root, "000")
    land_raw(lines.limit(1), root, "001")
    assert land_raw(lines, root, "000").count() == 2
    assert spark.read.parquet(f"{root}/RAW/raw_lines").count() == 3


@pytest.mark.parametrize("slices", [1, 7])
def test_lag_over_slices(spark, slices):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slices)
    try:
        df = spark.createDataFrame([(g, i, f"{g}-{i}") for g in ("a", "b", None) for i in range(40 if g == "a" else 3)], "g string, i int, v string")
        got = {(r.g, r.i): r.parent for r in lag_parent(df, ["g"], ["i"], "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {(g, i): None if i == 0 else f"{g}-{i - 1}" for g in ("a", "b", None) for i in range(40 if g == "a" else 3)}
