"""Row-level change feed between two versions of a table.

Rows are matched by key (NULL is a value) and compared by a hash of their
other columns: ``insert``, ``update`` (with the row as it is now) and
``delete`` (with the row as it was). Both sides are reduced to the partitions
named before they are joined, so a change feed of a merge reads the partitions
that the merge replaced (``upsert`` returns them) and no others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmart.sources.sink import same


def row_hash(columns: Sequence[str]) -> Column:
    """64-bit hash pair of a row's columns, NULLs told apart by position."""
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00NULL")) for c in columns]
    text = F.to_json(F.array(*parts)) if parts else F.lit("")
    return F.struct(F.xxhash64(text), F.md5(text))


def changes(before: DataFrame, after: DataFrame, key: Sequence[str] | str, partition: str | None = None,
            touched: Sequence | None = None, ignore: Sequence[str] = ()) -> DataFrame:
    """(change, columns of ``after``): the rows that differ between two versions with one row per key.

    ``partition`` and ``touched`` (its values) bound what is read; a key that
    moved between two touched partitions is one update. ``ignore`` names
    columns that do not count as a change, such as a load stamp.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = after.columns
    if partition is not None and touched is not None:
        here = F.col(partition).isin([t for t in touched if t is not None])
        if None in touched:
            here = here | F.col(partition).isNull()
        before, after = before.filter(here), after.filter(here)
    value = [c for c in columns if c not in keys and c not in ignore]
    # both versions in one shuffle by key instead of a join: a key has at most two rows
    rows = [df.select(*[F.col(f"`{c}`").alias(c) for c in keys], F.lit(new).alias("_new"), row_hash(value).alias("_hash"),
                      F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")) for df, new in ((before, False), (after, True))]
    pick = lambda c, new: F.any_value(F.when(F.col("_new") == new, F.col(c)), True)
    both = rows[0].unionByName(rows[1]).groupBy(*keys).agg(
        pick("_hash", False).alias("_old"), pick("_hash", True).alias("_is"),
        pick("_row", False).alias("_was"), pick("_row", True).alias("_now"))
    change = F.when(F.col("_old").isNull(), "insert").when(F.col("_is").isNull(), "delete").when(F.col("_old") != F.col("_is"), "update")
    return both.select(change.alias("change"), F.coalesce("_now", "_was").alias("_r")).filter("change IS NOT NULL").select("change", "_r.*")


def apply_changes(table: DataFrame, feed: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """The version after ``feed``, from the one before it."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = table.alias("t").join(feed.select(*keys).alias("f"), same("t", "f", keys), "left_anti")
    return kept.unionByName(feed.filter("change <> 'delete'").drop("change"))
