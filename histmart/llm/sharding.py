r"""Two-pass external shuffle into shards of near equal row counts.

Pass 1 scatters every row uniformly into buckets sized for memory: the bucket
is a seeded hash of the row's number, so equal rows, equal keys and a hot
source spread like any others, and Spark's shuffle writes the buckets to disk.
Pass 2 puts one bucket at a time into a fixed order, permutes it with the
built-in seeded Fisher-Yates ``shuffle`` and writes it. The buckets one after
another are the global order; each shard is a run of it, cut so that row
counts differ by at most one (law ``rows``), and ``slot`` is the place in the
shard.

Row numbers come from ``monotonically_increasing_id``: give a table read from
files or a staged one, whose partitions read the same again after a lost
executor. From the written buckets on, nothing depends on a rerun's order.

Defined cases: a NULL text has size 1 and the checksum of the empty text;
repeated rows are rows of their own; an empty table gives empty shards; input
columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histmart.llm.common import prepare, stage, text_or_empty

SHARDS = 8
SEED = 20_231
BUCKET_BYTES = 16 << 20
MAX_BROADCAST_BUCKETS = 200_000


def row_bytes(text: str = "text"):
    return (F.octet_length(text_or_empty(text)) + 1).cast("long")


def shuffled_buckets(df: DataFrame, text: str = "text", seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """Both passes: columns ``bucket``, ``place`` (in the bucket) and ``row``, written as a staged table; and
    the number of buckets."""
    prepare(df.sparkSession)
    total = df.agg(F.sum(row_bytes(text))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    number = F.monotonically_increasing_id()
    scattered = (df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), number.alias("number"))
                 .withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "number"), F.lit(buckets)).cast("int"))
                 .repartitionById(buckets, "bucket"))  # one bucket per task
    ordered = scattered.groupBy("bucket").agg(F.sort_array(F.collect_list(
        F.struct(F.xxhash64(F.lit(seed + 1), "number").alias("draw"), "number", "row"))).alias("rows"))
    permuted = ordered.select("bucket", F.posexplode(F.shuffle("rows", F.lit(seed + 2))).alias("place", "item"))
    return stage(permuted.select("bucket", "place", F.col("item.row").alias("row")), "shuffle-buckets"), buckets


def external_shuffle(df: DataFrame, n_shards: int = SHARDS, text: str = "text", seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Input columns plus ``shard`` (int) and ``slot`` (long, gapless from 0 in the shard)."""
    placed, buckets = shuffled_buckets(df, text, seed, bucket_bytes)
    counts = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # one number per bucket of bucket_bytes: bytes / bucket_bytes rows in this window
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
                           F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"))
    if buckets <= MAX_BROADCAST_BUCKETS:
        starts = F.broadcast(starts)  # one short row per bucket, else the rows would be shuffled again
    j = placed.join(starts, "bucket").select(
        "row", (F.col("start") + F.col("place")).alias("at"), "total")
    shard = F.expr(f"at * {n_shards}L div total")
    first = F.expr(f"(shard * total + {n_shards - 1}L) div {n_shards}L")
    keep = [c for c in df.columns if c not in ("shard", "slot")]
    return (j.withColumn("shard", shard).withColumn("slot", F.col("at") - first)
            .select(*[F.col("row")[c].alias(c) for c in keep], F.col("shard").cast("int").alias("shard"), "slot"))


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder per shard; a bucket's rows stay together, so no further shuffle is needed."""
    shards.write.partitionBy("shard").parquet(path)


def op9_query(docs: DataFrame) -> DataFrame:
    return external_shuffle(docs).select(
        "doc_id", row_bytes().alias("size"), F.crc32(text_or_empty().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
