"""Joins of the history models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmart.operators.dedup import latest_per_key


def full_outer_series(left: DataFrame, right: DataFrame, keys: Sequence[str],
                      left_keys: Sequence[str] | None = None,
                      right_keys: Sequence[str] | None = None,
                      coalesce_extra: Sequence[tuple[str, str, str]] = ()) -> DataFrame:
    """Full outer join on keys, keys coalesced (left side preferred).

    ``keys`` name the output key columns; ``left_keys``/``right_keys`` the
    join columns on each side (default: same names). ``coalesce_extra``
    adds (out, left_col, right_col) coalesced pairs such as a load stamp.
    """
    lk = list(left_keys or keys)
    rk = list(right_keys or keys)
    l = left.alias("l")
    r = right.alias("r")
    cond = None
    for a, b in zip(lk, rk):
        c = F.col(f"l.{a}") == F.col(f"r.{b}")
        cond = c if cond is None else cond & c
    joined = l.join(r, cond, "full_outer")
    key_cols = [F.coalesce(F.col(f"l.{a}"), F.col(f"r.{b}")).alias(k)
                for k, a, b in zip(keys, lk, rk)]
    extra = [F.coalesce(F.col(f"l.{a}"), F.col(f"r.{b}")).alias(o) for o, a, b in coalesce_extra]
    used_l = set(lk) | {a for _, a, _ in coalesce_extra}
    used_r = set(rk) | {b for _, _, b in coalesce_extra}
    rest = ([F.col(f"l.{c}") for c in left.columns if c not in used_l]
            + [F.col(f"r.{c}") for c in right.columns if c not in used_r])
    return joined.select(*key_cols, *extra, *rest)


def left_enrich_latest(fact: DataFrame, dim: DataFrame, keys: Sequence[str],
                       order: Sequence, tie_break: Sequence | None = None,
                       dim_cols: Sequence[str] | None = None) -> DataFrame:
    """Left join fact -> newest ``dim`` row per key (QUALIFY row_number()=1).

    No broadcast hint: the dimension grows with the feed, so the choice is
    left to the planner's size estimate and to AQE, which switches to a
    broadcast join at run time only when the measured side is small.
    """
    latest = latest_per_key(dim, keys, order, tie_break)
    if dim_cols is not None:
        latest = latest.select(*keys, *dim_cols)
    return fact.join(latest, list(keys), "left")


def offset_self_join(tokens: DataFrame, group: Sequence[str], idx: str = "i",
                     value: str = "t") -> DataFrame:
    """Reference form of the pair decode: token i joined to token i+1, even i.

    Kept for parity tests only; the library decodes pairs in-row instead
    (``series.pair_array``), which needs no join and no shuffle.
    """
    a = tokens.alias("a")
    b = tokens.alias("b")
    cond = F.col(f"b.{idx}") == F.col(f"a.{idx}") + 1
    for g in group:
        cond = cond & (F.col(f"a.{g}") == F.col(f"b.{g}"))
    return (a.join(b, cond, "inner")
            .where(F.col(f"a.{idx}") % 2 == 0)
            .select(*[F.col(f"a.{g}") for g in group],
                    F.col(f"a.{idx}").alias("pair_start"),
                    F.col(f"a.{value}").alias("key_token"),
                    F.col(f"b.{value}").alias("value_token")))
