"""Load ledger: a batch load takes each file once, without a stream.

The ledger is two Parquet tables partitioned by load: ``planned`` holds the
files of a load (path, size, time of change), written before anything is
loaded, ``loaded`` the same rows once the load is done. A run first finishes
planned loads that are not done, with the files and the name that they had,
so a load that replaces its own rows (``land_raw``) leaves the same table
however often it is begun; then it plans what the listing holds and no load
has. A file that changed in size or time is a new one, as it is for COPY.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.sources.files import Folder
from histmart.sources.raw import RAW_FILE_PATTERN, _load_date, parse_raw, read_lines_of
from histmart.sources.sink import layer_path, replace_partitions, same, table_exists

FILE = ["path", "size", "modified"]
SCHEMA = "path string, size bigint, modified timestamp, load string"


def list_files(spark: SparkSession, path: str, pattern: str | None = RAW_FILE_PATTERN) -> DataFrame:
    """(path, size, modified) of the files under ``path``; contents are not read."""
    if not Folder(spark, path).exists():
        return spark.createDataFrame([], SCHEMA).select(*FILE)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    return files.filter(F.col("path").rlike(pattern)) if pattern else files


class Ledger:
    """Which files were loaded, by which load."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self, table: str) -> DataFrame:
        path = f"{self.path}/{table}"
        if not table_exists(self.spark, path, SCHEMA):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(path)

    def open_loads(self) -> list[str]:
        """Loads planned and not done, in the order of their names (collected: one name per unfinished load)."""
        left = self.rows("planned").select("load").distinct().join(self.rows("loaded").select("load").distinct(), "load", "left_anti")
        return sorted(r["load"] for r in left.collect())

    def plan(self, files: DataFrame) -> str | None:
        """Plan a load of the ``files`` that no load has; its name, or None where there is none."""
        new = files.alias("f").join(self.rows("planned").alias("l"), same("f", "l", FILE), "left_anti")
        if new.isEmpty():
            return None
        load = f"{self.rows('planned').select('load').distinct().count():012d}"
        replace_partitions(new.withColumn("load", F.lit(load)), f"{self.path}/planned", ["load"])
        return load

    def files(self, load: str) -> DataFrame:
        return self.rows("planned").filter(F.col("load") == load)

    def done(self, load: str) -> None:
        replace_partitions(self.files(load), f"{self.path}/loaded", ["load"])


def load_once(spark: SparkSession, path: str, ledger: str, process: Callable[[DataFrame, str], None],
              pattern: str | None = RAW_FILE_PATTERN, load_date=None) -> list[str]:
    """``process(lines, load)`` for the unfinished loads, then for the files under ``path`` not loaded yet. The loads run.

    ``process`` must replace what an earlier attempt of the same load left.
    """
    book, ran = Ledger(spark, ledger), []

    def run(load: str) -> None:
        paths = [r["path"] for r in book.files(load).select("path").collect()]  # names of this load's files, as any read lists them
        process(read_lines_of(spark, paths).withColumn("ingest_dt", _load_date(load_date)), load)
        book.done(load)
        ran.append(load)

    for load in book.open_loads():
        run(load)
    load = book.plan(list_files(spark, path, pattern))
    if load is not None:
        run(load)
    return ran


def batch_pipeline(spark: SparkSession, landing: str, root: str, load_date=None, pattern: str | None = RAW_FILE_PATTERN,
                   full_refresh: bool = False) -> list[dict]:
    """The daily run as a batch: new files are landed in RAW/raw_lines (a partition per load), bad lines kept, models published.

    A repeated run without new files does nothing; an interrupted one is finished first.
    """
    from histmart.plans.pipeline import run_pipeline
    from histmart.streaming.incremental import keep_bad_lines, land_raw
    runs: list[dict] = []

    def process(lines: DataFrame, load: str) -> None:
        good, bad = parse_raw(land_raw(lines, root, f"load-{load}"))
        keep_bad_lines(bad, root)
        runs.append(run_pipeline(spark, good, root, full_refresh=full_refresh and not runs, run_id=f"load-{load}"))

    load_once(spark, landing, layer_path(root, "raw", "load_ledger"), process, pattern, load_date)
    return runs
