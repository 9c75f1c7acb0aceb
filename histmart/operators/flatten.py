"""Lateral flatten (G1-G3, U2, J4): positional explode of arrays and VARIANTs, inner or outer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flatten(df: DataFrame, arr, keep: Sequence[str] | None = None, outer: bool = False,
            index: str = "index", value: str = "value") -> DataFrame:
    """One row per element with its 0-based index.

    outer=True keeps rows whose array is NULL or empty, with NULL index and
    value (``lateral flatten(..., outer => true)``).
    """
    keep = list(keep) if keep is not None else [c for c in df.columns
                                                 if not (isinstance(arr, str) and c == arr)]
    gen = F.posexplode_outer if outer else F.posexplode
    return df.select(*keep, gen(_col(arr)).alias(index, value))


def flatten_variant(df: DataFrame, value: str, path: str = "$", keep: Sequence[str] | None = None, outer: bool = False,
                    index: str = "index", key: str = "key", out: str = "value") -> DataFrame:
    """One row per element (or field) of the VARIANT at ``path`` of column ``value``, by a lateral join with
    ``variant_explode``: its position, its field name (NULL in an array) and its VARIANT.

    outer=True keeps rows without any element, with NULLs; a path that leads nowhere has none. A JSON null and a scalar
    have no elements. The elements stay VARIANT, so they are flattened further or read path by path.
    """
    keep = list(keep) if keep is not None else [c for c in df.columns if c != value]
    inner = F.try_variant_get(F.col(value), path, "variant") if path != "$" else F.col(value)
    rows = df.select(*keep, inner.alias("_v"))
    tvf = df.sparkSession.tvf
    elements = (tvf.variant_explode_outer if outer else tvf.variant_explode)(F.col("_v").outer())
    found = rows.lateralJoin(elements.toDF("_at", "_key", "_value"))
    return found.select(*keep, F.col("_at").alias(index), F.col("_key").alias(key), F.col("_value").alias(out))


SPREAD = "_spread"


def inline_dealt(df: DataFrame, arr, key: str, keep: Sequence[str], spread) -> DataFrame:
    """(key, keep, _spread, element fields): one row per element of an array of structs, dealt by ``key`` while the array
    is still whole, so a shuffle carries a row per array and no task sorts elements before it.

    Rows without a key are one group however many they are: their elements go one by one, dealt by ``spread(element)``
    (a long). ``_spread`` is that value, NULL where there is a key; a group by ``key``, ``_spread`` and what ``spread``
    is made from is not shuffled again.
    """
    arr = _col(arr)
    whole = F.array(F.struct(F.lit(None).cast("long").alias(SPREAD), arr.alias("_rows")))
    each = F.transform(arr, lambda e: F.struct(spread(e).cast("long").alias(SPREAD), F.array(e).alias("_rows")))
    rows = df.select(key, *keep, F.inline(F.when(F.col(key).isNotNull(), whole).otherwise(each)))
    return rows.filter(F.col("_rows").isNotNull()).repartition(key, SPREAD).select(key, *keep, SPREAD, F.inline("_rows"))


def _asset_maker(tag, target, targets, type_name, idx_name):
    def one(x, i):
        return F.struct(
            F.lit(tag).alias(type_name), i.cast("int").alias(idx_name),
            *[(x.cast("string") if t == target else F.lit(None).cast("string")).alias(t)
              for t in targets],
        )
    return one


def tagged_assets(container, kinds: Sequence[tuple[str, str, str]],
                  type_name: str = "asset_type", idx_name: str = "asset_idx") -> Column:
    """Several array fields of one struct -> one tagged array (U2 in one pass).

    ``kinds`` = (tag, field, target column). Each output struct has the tag,
    the element index and the element in its target column, other targets
    NULL. An empty or missing field contributes one all-NULL element, like
    an outer flatten does, so the union of the four outer flattens is kept.
    """
    container = _col(container)
    targets = []
    for _, _, t in kinds:
        if t not in targets:
            targets.append(t)
    parts = []
    for tag, field, target in kinds:
        arr = container[field]
        one = _asset_maker(tag, target, targets, type_name, idx_name)
        empty = F.array(F.struct(
            F.lit(tag).alias(type_name), F.lit(None).cast("int").alias(idx_name),
            *[F.lit(None).cast("string").alias(t) for t in targets]))
        parts.append(F.when(F.coalesce(F.size(arr), F.lit(0)) > 0,
                            F.transform(arr, one)).otherwise(empty))
    return F.concat(*parts)
