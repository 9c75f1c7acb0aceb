"""Materialisation: overwrite, append, key upsert, high-water marks.

Plain Parquet has no MERGE, so ``upsert`` is written the way a Spark user
writes it: the target rows of the partitions touched, together with the
source rows, reduced to one row per key. With an ``order`` the winner is the
first row under it, wherever it stands, so an older load never replaces a
newer row and increments may come in any order or twice; without one the
source is recomputed truth and replaces what it matches.

Every write goes beside the table first and is then moved into place, whole
tables by two renames and partitioned tables one partition folder at a time.
A table without a time in its key is partitioned by a hash bucket of key
columns (``key_bucket``), so a merge rewrites the buckets that it touches.
A crash before the moves leaves the table as it was. Between the two renames
of a whole table the old one stands as ``<path>.__old`` and is put back by the
next access through this module. Partition moves are written to a journal
(``<path>.__journal``) before the first one, so after a crash between two moves,
where every partition is whole, old or new, the next access carries out the rest.
Untouched partitions are never read or rewritten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from histmart.operators.dedup import latest_per_key
from histmart.session import apply_defaults
from histmart.sources.files import Folder

# Warehouse layers and their schema names.
LAYERS = {"raw": "RAW", "stg": "STG", "stg_bad": "STG_BAD", "core": "CORE",
          "mart": "MART", "monitoring": "MONITORING"}


def layer_path(root: str, layer: str, model: str) -> str:
    """Route a model to ``root/<LAYER>/<model>``; unknown layers upper-cased as given."""
    schema = LAYERS.get(layer.lower(), layer.upper()) if layer else "PUBLIC"
    return f"{root.rstrip('/')}/{schema}/{model}"


def table_exists(spark: SparkSession, path: str, schema=None) -> bool:
    """True when ``path`` holds a table. Only the file system is asked, and its errors rise: a read that fails is no
    missing table.

    With a known ``schema`` nothing is inferred, so an existing empty table
    (a folder without data files) counts as present; without one it counts
    as absent.
    """
    recover(spark, path)
    folder = Folder(spark, path)
    return folder.exists() if schema is not None else folder.has_files()


BUCKET = "_bucket"


def bucket_column(spark: SparkSession, path: str, buckets: int) -> tuple[str, int]:
    """Name of the bucket column of the table at ``path`` and its number of buckets.

    The name carries the number (``_bucket64``), so an existing table keeps the
    number that its rows were dealt by, whatever is asked for now.
    """
    recover(spark, path)
    folder = Folder(spark, path)
    names = [x.split("=")[0] for x in folder.children() if x.startswith(BUCKET) and "=" in x] if folder.exists() else []
    name = names[0] if names else f"{BUCKET}{buckets}"
    return name, int(name.removeprefix(BUCKET))


def key_bucket(columns: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by a hash of key columns (NULL is a value), the same in every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation: a named, lazily evaluated plan (no data written)."""
    df.createOrReplaceTempView(name)
    return df


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a run that ended early had begun: put the previous table back if it ended between the two renames of
    ``replace_table``, and carry out the moves left in the journal of ``replace_partitions``."""
    table, old, journal = (Folder(spark, path + x) for x in ("", ".__old", JOURNAL))
    if old.exists() and not table.exists():
        old.move("", table, "")
    if journal.exists():
        _carry_out(spark, path, json.loads(journal.read_text()))


JOURNAL = ".__journal"


def _carry_out(spark: SparkSession, path: str, moves: dict) -> None:
    """Move partitions as the journal says. Moves already made are seen and left, so it may be begun any number of times."""
    table, fresh, trash = (Folder(spark, x) for x in (path, moves["fresh"], moves["trash"]))
    for folder in moves["replaced"]:
        if fresh.exists(folder):
            if table.exists(folder):
                table.move(folder, trash, folder)
            fresh.move(folder, table, folder)
    for folder in moves["emptied"]:
        if table.exists(folder):
            table.move(folder, trash, folder)
    Folder(spark, path + JOURNAL).delete()
    fresh.delete()
    trash.delete()


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace the whole table, also partitions that the new rows do not have."""
    spark = df.sparkSession
    recover(spark, path)
    new = f"{path}.__new-{uuid.uuid4().hex}"
    _write(df, new, partition_by)
    table, old, fresh = Folder(spark, path), Folder(spark, path + ".__old"), Folder(spark, new)
    if old.exists():
        old.delete()
    if table.exists():
        table.move("", old, "")
    fresh.move("", table, "")
    old.delete()


overwrite = replace_table


def _write(df: DataFrame, path: str, partition_by: Sequence[str] | None) -> None:
    buckets = [c for c in partition_by or [] if c.startswith(BUCKET)]
    if buckets:  # rows of a bucket together; adaptive execution splits large buckets and joins small ones
        df = df.hint("rebalance", *[F.col(c) for c in buckets])
    w = df.write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], touched: Sequence[str] = ()) -> list[str]:
    """Replace the partition folders of ``df`` and the ``touched`` ones (relative, emptied if ``df`` has no row there).

    Returns the folders replaced, a list as long as the partitions touched.
    """
    spark = df.sparkSession
    recover(spark, path)
    new = f"{path}.__new-{uuid.uuid4().hex}"
    _write(df, new, partition_by)
    found = Folder(spark, new).leaves()
    moves = {"fresh": new, "trash": f"{path}.__out-{uuid.uuid4().hex}", "replaced": found, "emptied": sorted({*touched} - {*found})}
    Folder(spark, path + JOURNAL).write_text(json.dumps(moves))
    _carry_out(spark, path, moves)
    return sorted({*found, *touched})


def append(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# Settings of a session whose Parquet scans answer max from file footers, where the type has it there (dates and numbers).
FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
NESTED = (ArrayType, MapType, StructType, VariantType)
NO_STATISTICS = "No min/max found for Parquet file"  # fixed value: what Spark says of such a footer


def newest(spark: SparkSession, path: str, column: str, as_date: bool = False) -> DataFrame:
    """One row with m = max(column) of the table at ``path``, from its footers alone for dates and numbers; text and
    timestamps have no such footers and are read, that column only. So is a column of a table with nested ones: Spark
    takes a column's place in the schema for its place in the footer, where every leaf of a nested one stands by itself.
    Runs in a session of its own, so the settings stay there."""
    own = spark.newSession()
    apply_defaults(own)
    for k, v in FOOTER_SETTINGS.items():
        own.conf.set(k, v)
    c = F.col(column).cast("date") if as_date else F.col(column)
    rows = own.read.parquet(path)
    if any(isinstance(f.dataType, NESTED) for f in rows.schema.fields):
        own.conf.set("spark.sql.parquet.aggregatePushdown", "false")
    return rows.agg(F.max(c).alias("m"))


def high_water(spark: SparkSession, path: str, column: str, as_date: bool = False,
               default: str = "1900-01-01"):
    """max(column) of the target, or ``default`` when the target is absent/empty.

    One scalar is collected; it is then used as a literal so the increment
    filter reaches the Parquet scan. Where a file's footer has no maximum (a
    column that is NULL throughout the file) the column is read; any other
    error rises.
    """
    if not table_exists(spark, path):
        return default
    try:
        v = newest(spark, path, column, as_date).first()["m"]
    except Exception as ex:  # noqa: BLE001
        if NO_STATISTICS not in str(ex):
            raise
        c = F.col(column).cast("date") if as_date else F.col(column)
        v = spark.read.parquet(path).agg(F.max(c).alias("m")).first()["m"]
    return default if v is None else v


def increment_filter(src_col, mark, mode: str = "strict", as_date: bool = False):
    """Predicate for new source rows: ``>`` (strict) or ``>=`` (inclusive)."""
    c = F.col(src_col) if isinstance(src_col, str) else src_col
    if as_date:
        c = c.cast("date")
        lit = F.lit(str(mark)).cast("date")
    else:
        lit = F.lit(mark)
    return c > lit if mode == "strict" else c >= lit


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe equality of columns between two aliases."""
    return reduce(lambda x, y: x & y, [F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns])


def _folders(rows: DataFrame, path: str) -> list[str]:
    """Relative partition folders of rows read from ``path`` (collected: one short text per partition)."""
    root = unquote(path.rstrip("/").split("/")[-1])
    files = rows.select(F.regexp_replace("__file", "/[^/]*$", "").alias("f")).distinct().collect()
    return [unquote(r["f"]).rsplit(f"/{root}/", 1)[1] for r in files if f"/{root}/" in unquote(r["f"])]


def upsert(spark: SparkSession, src: DataFrame, path: str, key: Sequence[str] | str,
           partition_by: Sequence[str] | None = None, order: Sequence | None = None,
           full_refresh: bool = False, unique_source: bool = False, null_keys: str = "set_aside",
           fixed_partition: bool = False) -> dict:
    """MERGE by key. Returns counts and the partition folders replaced.

    ``order``: the row that comes first under it stays, of the target or of the
    source; it must be total for a repeatable choice. Without it a matched
    target row is replaced (``unique_source``: the source has one row per key).

    ``null_keys``: ``set_aside`` moves source rows with a NULL key part to the
    table ``<path>__null_keys`` (kept once each, counted in the result), since
    a MERGE would never match them; ``match`` treats NULL as a value.

    A key whose partition changed is found in its old partition and moved;
    ``fixed_partition`` says that the key determines the partition, which saves
    reading the keys of the other partitions.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = list(partition_by or [])
    result: dict = {"null_keys": 0, "partitions": []}
    if null_keys == "set_aside":
        missing = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
        result["null_keys"] = _set_aside(spark, src.filter(missing), f"{path}__null_keys")
        src = src.filter(~missing)
    if order:
        src = latest_per_key(src, keys, order)
    elif not unique_source:
        src = src.dropDuplicates(keys)

    if full_refresh or not table_exists(spark, path, src.schema):
        replace_table(src, path, parts)
        return result | {"mode": "overwrite"}

    target = spark.read.schema(src.schema).parquet(path).select("*", F.col("_metadata.file_path").alias("__file"))
    touched: list[str] = []
    if parts:
        near = src.select(*parts)
        if not (fixed_partition or set(parts) <= set(keys)):
            hit = target.select(*dict.fromkeys(keys + parts), "__file").alias("t").join(
                src.select(*keys).alias("s"), same("t", "s", keys), "left_semi")
            touched = _folders(hit, path)
            near = near.unionByName(hit.select(*parts))
        target = target.alias("t").join(near.distinct().alias("p"), same("t", "p", parts), "left_semi")
    rows = target.drop("__file").select(*src.columns)
    if order:
        merged = latest_per_key(rows.unionByName(src), keys, order)
    else:
        merged = rows.alias("t").join(src.select(*keys).alias("s"), same("t", "s", keys), "left_anti").unionByName(src)
    if parts:
        result["partitions"] = replace_partitions(merged, path, parts, touched)
    else:
        replace_table(merged, path)
    return result | {"mode": "merge"}


def _set_aside(spark: SparkSession, rows: DataFrame, path: str) -> int:
    """Keep rows whose key is NULL, each different row once (a replay adds nothing). Returns how many came."""
    n = rows.count()
    if n:
        if table_exists(spark, path, rows.schema):
            rows = spark.read.schema(rows.schema).parquet(path).unionByName(rows)
        replace_table(rows.distinct(), path)
    return n
