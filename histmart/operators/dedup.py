"""Keep-one-row-per-key operators.

Ordering follows the warehouse convention: DESC puts NULLs first, ASC puts
NULLs last (Spark's defaults are the reverse, so every order is spelled
out). ``row_number() = 1`` is planned by Spark as a *partial*
WindowGroupLimit before the shuffle and a final one after it: each map task
keeps at most one row per key, so a key that holds a third of all rows
still ships one row per map task, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmart.session import shared_path

Order = "str | tuple[str, str] | Column"


def order_col(spec) -> Column:
    """'c' / ('c','desc') / ('c','asc') / Column -> Column with warehouse null order."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, str):
        spec = (spec, "asc")
    name, direction = spec
    c = F.col(name)
    return c.desc_nulls_first() if direction.lower() == "desc" else c.asc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence,
                   tie_break: Sequence | None = None) -> DataFrame:
    """First row per ``keys`` under ``order`` (row_number() = 1 semantics).

    ``tie_break`` adds total-order columns after ``order`` so the pick is
    deterministic when the order columns tie (a load stamp that is only a
    date ties often).
    """
    cols = [order_col(o) for o in list(order) + list(tie_break or [])]
    w = Window.partitionBy(*keys).orderBy(*cols)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def last_of_day(df: DataFrame, keys: Sequence[str], ts: str, load: str = "ingest_ts",
                date_col: str = "date", tie_break: Sequence | None = None) -> DataFrame:
    """Last point per (keys, calendar day): newest load first, then latest time."""
    with_day = df.withColumn(date_col, F.col(ts).cast("date"))
    return latest_per_key(with_day, list(keys) + [date_col],
                          [(load, "desc"), (ts, "desc")], tie_break)


def first_by_value(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Smallest row per key by ascending ``by`` (NULLs last)."""
    return latest_per_key(df, keys, [(c, "asc") for c in by])


def lag_parent(df: DataFrame, partition: Sequence[str], order: Sequence, value: str,
               out: str = "parent") -> DataFrame:
    """Previous ``value`` within the partition under ``order`` (W4), also for a hot group.

    Rows are range-partitioned by (partition, order) and written, so a group
    that holds a third of the rows lies in many slices. The lag is taken inside
    each slice; a slice's first row of a group takes the last value of the
    group's slice before, from a table of one row per (slice, group).
    """
    spark, cols = df.sparkSession, [order_col(o) for o in order]
    keys = [order_col(c) for c in partition]
    path = shared_path(spark, "lag-slices")
    sliced = df.repartitionByRange(*keys, *cols).withColumn("__slice", F.spark_partition_id())
    sliced.write.parquet(path)
    sliced = spark.read.schema(sliced.schema).parquet(path)
    group = Window.partitionBy("__slice", *partition)
    marked = (sliced.withColumn(out, F.lag(F.col(value)).over(group.orderBy(*cols)))
              .withColumn("__n", F.row_number().over(group.orderBy(*cols))))
    ends = marked.withColumn("__all", F.count(F.lit(1)).over(group)).filter("__n = __all").select(
        "__slice", *partition, F.col(value).alias("__last"))
    before = ends.withColumn("__before", F.lag("__last").over(Window.partitionBy(*partition).orderBy("__slice")))
    m, e = marked.alias("m"), before.alias("e")
    same = F.col("m.__slice") == F.col("e.__slice")
    for c in partition:
        same = same & F.col(f"m.{c}").eqNullSafe(F.col(f"e.{c}"))
    value_of = F.when(F.col("m.__n") == 1, F.col("e.__before")).otherwise(F.col(f"m.{out}"))
    return m.join(e, same, "left").select(*[F.col(f"m.{c}") for c in df.columns if c != out], value_of.alias(out))


def previous_in_array(arr, field: str | None = None) -> Column:
    """Row-local lag: element i paired with element i-1 of the same array.

    For a path stored as one array per row this replaces flatten + lag
    window (a shuffle and a sort) by a per-row transform.
    """
    arr = F.col(arr) if isinstance(arr, str) else arr
    def prev(x, i):
        p = F.get(arr, i - 1)
        return F.struct(x.alias("item"), (p[field] if field else p).alias("previous"))
    return F.transform(arr, prev)
