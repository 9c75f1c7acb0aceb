"""Helpers shared by the operators: session settings, table paths, staged tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histmart.session import apply_defaults, shared_path

# Arrow batches towards Python workers are bounded in rows and bytes, so a run
# of very long texts cannot build one huge batch.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# Fixed value: characters that separate words (space and U+0009 to U+000D).
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"

# Paths staged in the scopes now open in this thread, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("staged tables", default=())


def prepare(spark: SparkSession) -> None:
    """Pin the settings the operators rely on (idempotent)."""
    apply_defaults(spark)
    for k, v in ARROW_SETTINGS.items():
        spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _on_its_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def stage(df: DataFrame, name: str, keep: bool = False, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The written table cuts the lineage: what follows re-reads it after a lost
    executor instead of repeating Python work or a nondeterministic order. It
    is deleted when the innermost ``scratch`` block ends (``keep``: the block
    around that one), and otherwise with the application. ``group_rows``: most rows of a row group, for rows so large that a
    task should hold few; the writer and the reader hold one group.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    scopes = _SCOPES.get()[:-1] if keep else _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    system, place = _on_its_system(spark, path)
    writer = df.write.option("compression", "zstd")
    (writer.option("parquet.block.row.count.limit", group_rows) if group_rows else writer).parquet(path)
    system.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside the block when it ends; tables of other results stay."""
    mine: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), mine))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in mine:
            system, place = _on_its_system(spark, path)
            system.delete(place, True)


def _give_back() -> None:
    """Return freed memory to the system: workers live on between tasks and stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)


def trimmed(run):
    """``run`` for mapInArrow, giving its memory back when its partition is done."""
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            _give_back()
    return inner


def trimmed_group(run):
    """``run`` for applyInArrow (one table or two), giving its memory back after each group."""
    def one(table):
        try:
            return run(table)
        finally:
            _give_back()

    def two(left, right):
        try:
            return run(left, right)
        finally:
            _give_back()
    return two if run.__code__.co_argcount == 2 else one


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bind(value: Column, body) -> Column:
    """``body`` of ``value``, computed once: inside a lambda a plain expression would be computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    """Words of a text without NULL: maximal runs of other characters than WORD_SPACE."""
    trimmed = F.btrim(text, F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT, -1))


BITMAP_BITS = 1 << 26  # 2,048 rows of 4 KB, whatever is put in


def bitmap(df: DataFrame, column: str) -> DataFrame:
    """(_bucket, _bits): one bit for the hash of every value of ``column``, at most 8 MB."""
    h = F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)) + 1
    return df.select(F.bitmap_bucket_number(h).alias("_bucket"), F.bitmap_bit_position(h).alias("_at")).groupBy("_bucket").agg(
        F.bitmap_construct_agg("_at").alias("_bits"))


def marked(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """``df`` with _may: false only where ``column`` is not among the values of ``bits`` (no shuffle: the bitmap is broadcast)."""
    h = F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)) + 1
    placed = df.withColumn("_bucket", F.bitmap_bucket_number(h)).withColumn("_at", F.bitmap_bit_position(h))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return placed.join(F.broadcast(bits), "_bucket", "left").withColumn(
        "_may", F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1, F.lit(False))).drop("_bucket", "_at", "_bits")


def may_hold(df: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """The rows whose ``column`` may be among the values of ``bits``: all of those, and few others while the bitmap is
    sparse. It spares a join's shuffle rows without a partner; the join decides."""
    return marked(df, column, bits).filter("_may").drop("_may")
