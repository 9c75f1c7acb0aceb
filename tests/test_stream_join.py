"""Stream-stream full outer join against the batch join, with marks, NULL keys and late points."""

import datetime as dt

from pyspark.sql import functions as F

from histmart.session import shared_path
from histmart.streaming.incremental import stream_full_outer, table_stream

DAY = dt.datetime(2024, 1, 1)


def _rows(spark, value, rows):
    return spark.createDataFrame([(k, DAY + dt.timedelta(hours=h) if h is not None else None, v, l) for k, h, v, l in rows],
                                 f"k string, t timestamp_ntz, {value} int, load int")


def _runs(spark, days):
    """One run of the stream for each pair of row lists; the table after each run."""
    folders = [shared_path(spark, f"sj-{x}") for x in "lr"]
    target, checkpoint = shared_path(spark, "sj-out"), shared_path(spark, "sj-ckpt")
    for sides in days:
        for folder, value, rows in zip(folders, ("a", "b"), sides):
            _rows(spark, value, rows).write.mode("append").parquet(folder)
        counts = stream_full_outer(spark, *[table_stream(spark, f, None) for f in folders], target, ["k"], "t", checkpoint)
        yield counts, sorted((tuple(r) for r in spark.read.parquet(target).select("k", "t", "load", "a", "b").collect()), key=repr)


def _mark(hours):
    return [("mark-l", hours, 0, 0)], [("mark-r", hours + 1, 0, 0)]


def test_equals_the_batch_join_when_the_marks_have_passed(spark):
    left = [("x", 0, 1, 1), ("x", 5, 2, 1), ("y", 0, 3, 1), (None, 5, 4, 1), ("z", 30, 5, 1), ("z", 30, 6, 2), ("x", None, 7, 1)]
    right = [("x", 0, 10, 2), ("y", 1, 30, 2), (None, 5, 40, 2), ("z", 30, 50, 3), ("x", None, 70, 1)]
    first = [r for r in left if r[1] is None or r[1] < 24], [r for r in right if r[1] is None or r[1] < 24]
    second = [r for r in left if r[1] and r[1] >= 24], [r for r in right if r[1] and r[1] >= 24]
    (_, early), (_, _), (last, got) = _runs(spark, [first, second, _mark(24 * 30)])
    assert early == [("x", DAY, 1, 1, 10)]     # pairs at once, single points later
    l, r = (_rows(spark, v, x).filter("t IS NOT NULL") for v, x in (("a", left), ("b", right)))
    batch = l.alias("l").join(r.alias("r"), F.expr("l.k = r.k AND l.t = r.t"), "full_outer").select(
        F.expr("coalesce(l.k, r.k)"), F.expr("coalesce(l.t, r.t)"), F.expr("coalesce(l.load, r.load)"), "a", "b")
    assert got == sorted((tuple(x) for x in batch.collect()), key=repr) and len(got) == 8
    assert last["state_rows"] == 2             # the marks alone are held


def test_late_points_are_dropped_and_counted(spark):
    days = [([("x", 0, 1, 1)], [("x", 0, 2, 1)]), _mark(24 * 10), ([("x", 1, 9, 1)], [("y", 24 * 11, 1, 1)]), _mark(24 * 40)]
    counts, tables = zip(*_runs(spark, days))
    assert sum(c["late_rows"] for c in counts) == 1
    assert not any(a == 9 for *_, a, _ in tables[-1])
    assert ("y", DAY + dt.timedelta(days=11), 1, None, 1) in tables[-1]
