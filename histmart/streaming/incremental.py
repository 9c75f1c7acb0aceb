"""Incremental runs as Structured Streaming jobs.

A file-source stream with a checkpoint processes each new file exactly
once; ``trigger(availableNow=True)`` turns it into a resumable batch job
(the daily run), and ``foreachBatch`` applies the key upsert of the model
to each micro-batch. Re-running after a crash replays only the batches the
checkpoint did not commit, and every sink is idempotent (ordered upserts by
key, batch-keyed raw partitions), so a replayed batch leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.operators.dedup import last_of_day
from histmart.sources.files import Folder
from histmart.sources.raw import RAW_FILE_PATTERN
from histmart.sources.sink import layer_path, replace_partitions, upsert


def run_available_now(stream: DataFrame, process: Callable[[DataFrame, int], None],
                      checkpoint: str) -> None:
    """Run ``process(batch_df, batch_id)`` over everything available, then stop."""
    q = (stream.writeStream.foreachBatch(process)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def ndjson_stream(spark: SparkSession, path: str, pattern: str | None = RAW_FILE_PATTERN,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """New raw lines (file source, insert-only) with lineage; parsed downstream."""
    r = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = r.load(path).select(F.col("value").alias("line"),
                                F.col("_metadata.file_path").alias("file_path"),
                                F.col("_metadata.file_name").alias("file_name"),
                                F.col("_metadata.file_modification_time").alias("file_modified"))
    if pattern:
        lines = lines.filter(F.col("file_path").rlike(pattern))
    return lines.filter(F.length(F.trim(F.col("line"))) > 0)


def table_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """A Parquet table as a file stream, stored as one file or as a folder of any number of files."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if Folder(spark, path).is_dir():
        return r.parquet(path)
    folder, name = path.rsplit("/", 1)
    return r.option("pathGlobFilter", name).parquet(folder)


def stream_last_of_day(spark: SparkSession, source: DataFrame, target: str, keys, ts: str,
                       load: str, checkpoint: str, tie_break=None) -> None:
    """Keep the last row per (keys, day) of a stream in ``target``.

    Each micro-batch is reduced to its last-of-day rows and merged by the real
    key columns (NULL is a value) under the same total order, so the table is
    the same for any order and grouping of the files.
    """
    order = [(load, "desc"), (ts, "desc")] + list(tie_break or [])

    def process(batch: DataFrame, batch_id: int) -> None:
        cand = last_of_day(batch, keys, ts, load=load, tie_break=tie_break)
        upsert(spark, cand, target, [*keys, "date"], partition_by=["date"], order=order, null_keys="match")

    run_available_now(source, process, checkpoint)


def stream_windowed_latest(spark: SparkSession, source: DataFrame, target: str, keys, ts: str,
                           payload, tie: str, checkpoint: str, late: str = "merge", delay: str = "2 days",
                           bucket: str = "1 day") -> dict:
    """Latest row per (keys, calendar bucket) of a stream, merged into ``target``.

    ``payload`` holds ``ts`` and ``tie``, the order within a bucket; rows without
    an event time belong to no bucket. Late rows:

    * ``merge`` (default): each micro-batch is reduced per tumbling window (a
      partial ``max_by`` per task) and merged in order; no row is dropped and
      the file order does not matter.
    * ``drop``: a watermark bounds the state of a stateful window; rows later
      than ``delay`` behind the newest event seen are dropped, and their number
      is returned as ``late_rows``.
    """
    if late not in ("merge", "drop"):
        raise ValueError("late must be 'merge' or 'drop'")
    order = [(ts, "desc"), (tie, "desc")]

    def latest(ev: DataFrame) -> DataFrame:
        rows = ev.groupBy(F.window("_event_ts", bucket).alias("w"), *keys).agg(
            F.max_by(F.struct(*payload), F.struct(F.col(ts), F.col(tie))).alias("row"))
        return rows.select(*keys, F.col("w.start").cast("date").alias("date"), "row.*")

    def merge(rows: DataFrame) -> None:
        upsert(spark, rows, target, [*keys, "date"], partition_by=["date"], order=order, null_keys="match")

    ev = source.withColumn("_event_ts", F.col(ts).cast("timestamp"))
    if late == "merge":
        run_available_now(ev, lambda batch, batch_id: merge(latest(batch)), checkpoint)
        return {"late_rows": 0}
    q = (latest(ev.withWatermark("_event_ts", delay)).writeStream.outputMode("update")
         .foreachBatch(lambda batch, batch_id: merge(batch))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return {"late_rows": sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)}


def stream_deduplicated(spark: SparkSession, source: DataFrame, target: str, keys, ts: str, checkpoint: str,
                        delay: str = "2 days") -> dict:
    """Append each key of a stream once to ``target``, where its repeats come within ``delay`` of one another.

    The state store holds the keys of ``delay`` behind the newest event and no more. Rows later than that are
    dropped (policy ``drop``) and counted as ``late_rows``; rows without an event time are not taken.
    """
    ev = source.withColumn("_event_ts", F.col(ts).cast("timestamp")).filter("_event_ts IS NOT NULL")
    once = ev.withWatermark("_event_ts", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_event_ts")
    q = (once.writeStream.outputMode("append").format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return {"late_rows": sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators)}


def stream_full_outer(spark: SparkSession, left: DataFrame, right: DataFrame, target: str, keys: Sequence[str], ts: str,
                      checkpoint: str, delay: str = "2 days") -> dict:
    """Full outer join of two streams on ``keys`` and the time ``ts``, appended to ``target`` (J2 on T1).

    Pairs are written when they meet; a point alone once both streams are
    ``delay`` past it, so the state holds the points of ``delay`` behind the
    slower stream and no more. Columns that both sides have are taken from the
    left one where it has a row. Points later than ``delay`` are dropped and
    counted as ``late_rows``; points without a time are not taken; a NULL key
    meets nothing. ``state_rows`` counts the points still held: those that the
    marks have not passed yet come with the next run over the same checkpoint.
    """
    def side(stream: DataFrame, name: str) -> DataFrame:
        ev = stream.filter(F.col(ts).isNotNull()).withColumn("_event_ts", F.col(ts).cast("timestamp"))
        whole = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
        # the state store finds NULL by NULL; a batch join does not
        return ev.withColumn("_meets", F.when(whole, "both").otherwise(name)).withWatermark("_event_ts", delay).alias(name)

    same = reduce(lambda x, y: x & y, [F.col(f"l.`{k}`") == F.col(f"r.`{k}`") for k in [*keys, "_meets", "_event_ts"]])
    joined = side(left, "l").join(side(right, "r"), same, "full_outer")
    both = [c for c in left.columns if c in right.columns]
    out = joined.select(
        *[F.coalesce(F.col(f"l.`{c}`"), F.col(f"r.`{c}`")).alias(c) for c in both],
        *[F.col(f"l.`{c}`") for c in left.columns if c not in both], *[F.col(f"r.`{c}`") for c in right.columns if c not in both])
    q = (out.writeStream.outputMode("append").format("parquet").option("path", target)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    held = [s.numRowsTotal for s in q.lastProgress.stateOperators] if q.lastProgress else []
    return {"late_rows": sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators), "state_rows": sum(held)}


def stream_pipeline(spark: SparkSession, landing: str, root: str, checkpoint: str,
                    load_date=None, pattern: str | None = RAW_FILE_PATTERN,
                    max_files_per_trigger: int | None = None) -> list[dict]:
    """The daily run driven by the raw file stream: each new file is loaded once.

    Every micro-batch of new NDJSON lines is landed in RAW/raw_lines (a
    partition per batch, replaced when the batch is replayed), parsed from
    there (bad lines kept once each, with their number, under
    STG_BAD/raw_bad_lines) and published with ``run_pipeline``. The stream
    checkpoint makes a rerun after a failure resume at the first uncommitted
    batch; a replayed batch leaves every table unchanged.
    """
    from histmart.plans.pipeline import run_pipeline
    from histmart.sources.raw import _load_date, parse_raw
    runs: list[dict] = []

    def process(batch: DataFrame, batch_id: int) -> None:
        lines = land_raw(batch.withColumn("ingest_dt", _load_date(load_date)), root, f"{batch_id:012d}")
        good, bad = parse_raw(lines)
        keep_bad_lines(bad, root)
        runs.append(run_pipeline(spark, good, root, run_id=f"batch-{batch_id}"))

    run_available_now(ndjson_stream(spark, landing, pattern, max_files_per_trigger), process, checkpoint)
    return runs


def keep_bad_lines(bad: DataFrame, root: str) -> None:
    """Merge bad lines into STG_BAD/raw_bad_lines, each once with the number of lines like it."""
    bad = bad.groupBy(*bad.columns).agg(F.count(F.lit(1)).alias("n_lines"))
    upsert(bad.sparkSession, bad, layer_path(root, "stg_bad", "raw_bad_lines"), "bad_row_id", unique_source=True)


def land_raw(lines: DataFrame, root: str, batch: str) -> DataFrame:
    """Write a batch of raw lines to its partition of RAW/raw_lines and read it back.

    A replay replaces the partition; a backfill reparses the table instead of the source files.
    """
    spark, path = lines.sparkSession, layer_path(root, "raw", "raw_lines")
    replace_partitions(lines.withColumn("batch", F.lit(batch)), path, ["batch"])
    schema = lines.withColumn("batch", F.lit(batch)).schema
    return spark.read.schema(schema).parquet(path).filter(F.col("batch") == batch).drop("batch")
