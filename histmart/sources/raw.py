"""Raw NDJSON loading (S1-S9) and driver-table access.

Lines are read as text, so a malformed line is *kept* (routed to
quarantine with its text) instead of being skipped; the JSON is parsed on
the executors with ``try_parse_json`` into a VARIANT for audit. Every file
is one or more tasks (a ``.gz`` file is one task), so parallelism follows
the number of files.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: raw files are gzip NDJSON named *.jsonl.gz in any subfolder.
RAW_FILE_PATTERN = r"(?i).*\.jsonl\.gz$"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Session setting: round-robin the derived feed's input over so many partitions (default: as scanned).
SPREAD_SETTING = "histmart.feed.partitions"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``partitions``, for inputs stored with too few splits; default: as it is.

    An explicit choice of the caller (argument or session setting), not of the
    input's size: plans are the same on any amount of data.
    """
    n = partitions or int(df.sparkSession.conf.get(SPREAD_SETTING, "0"))
    return df.repartition(n) if n else df


def _load_date(load_date) -> "F.Column":
    if load_date is None:
        return F.current_date()
    if isinstance(load_date, (str, _dt.date)):
        return F.lit(str(load_date)).cast("date")
    return load_date


def read_ndjson_lines(spark: SparkSession, path: str, pattern: str | None = RAW_FILE_PATTERN,
                      load_date=None) -> DataFrame:
    """Text lines of every matching file under ``path`` (recursive).

    Columns: line, file_path, file_name, file_modified, ingest_dt. Blank
    lines are dropped. ``load_date`` pins the load stamp so reruns repeat.
    """
    lines = _with_lineage(spark.read.option("recursiveFileLookup", "true").text(path))
    if pattern:
        lines = lines.filter(F.col("file_path").rlike(pattern))
    return lines.withColumn("ingest_dt", _load_date(load_date))


def read_lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text lines of the files named, with lineage and without blank lines."""
    return _with_lineage(spark.read.text(paths))


def _with_lineage(text: DataFrame) -> DataFrame:
    lines = text.select(F.col("value").alias("line"),
                        F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_name").alias("file_name"),
                        F.col("_metadata.file_modification_time").alias("file_modified"))
    return lines.filter(F.length(F.trim(F.col("line"))) > 0)


def parse_raw(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): good rows have ``payload`` VARIANT; bad keep the line text."""
    parsed = lines.withColumn("payload", F.try_parse_json(F.col("line")))
    good = parsed.filter(F.col("payload").isNotNull())
    bad = (parsed.filter(F.col("payload").isNull())
           .select(F.md5(F.concat_ws("|", F.col("file_path"), F.col("line"))).alias("bad_row_id"),
                   "file_path", "line", "ingest_dt",
                   F.lit("JSON_PARSE_ERROR").alias("reason_code"),
                   F.lit("line is not valid JSON").alias("reason_detail")))
    return good, bad


def read_ndjson(spark: SparkSession, path: str, pattern: str | None = RAW_FILE_PATTERN,
                load_date=None) -> tuple[DataFrame, DataFrame]:
    """Bulk load: (raw rows, bad lines). Raw = payload VARIANT + line + lineage."""
    return parse_raw(read_ndjson_lines(spark, path, pattern, load_date))


def read_json_array(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """JSON files holding one outer array: each element becomes a row."""
    r = spark.read.option("multiLine", "true")
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def load_status(raw: DataFrame, as_of, date_col: str = "ingest_dt") -> DataFrame:
    """'Loaded rows: N' for one load day (S7, A5). ``as_of`` = date or Column."""
    day = as_of if not isinstance(as_of, (str, _dt.date)) else F.lit(str(as_of)).cast("date")
    return (raw.filter(F.col(date_col) == day)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.concat(F.lit("Loaded rows: "), F.col("n").cast("string")).alias("status")))
