"""Interleaved time-series decoding.

Series arrive as ``[minute, value, minute, value, ...]`` inside one row
(numeric array) or as comma text. The warehouse decoded them with a
flatten + group-by or a flatten + self-join, i.e. a shuffle per series.
Here the pairing happens *inside the row* with higher-order functions and
one ``inline`` generator, so decoding never shuffles and a product with a
huge history is split across no group at all: the cost is linear in the
array and stays in the task that read the row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Price channels of the product csv array (name, index).
PRICE_CHANNELS = (("AMAZON", 0), ("NEW", 1), ("USED", 2), ("LISTPRICE", 4))
# Other csv channel indexes.
RANK_CHANNEL = 3
RATING_CHANNEL = 16
REVIEW_COUNT_CHANNEL = 17


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pair_array(arr, keep_partial: bool = True, key_name: str = "minute",
               value_name: str = "value", idx_name: str = "pair_idx") -> Column:
    """``[k0, v0, k1, v1, ...]`` -> ``array<struct<pair_idx, k, v>>``.

    keep_partial=True keeps an odd trailing key with a NULL value (the
    group-by decode); False drops it (the self-join decode). NULL or empty
    input gives NULL, i.e. no rows after ``inline``. One lambda call per
    pair: ``sequence`` enumerates pair numbers, ``get`` reads both halves.
    """
    arr = _col(arr)
    size = F.size(arr)
    n = F.floor((size + 1) / 2) if keep_partial else F.floor(size / 2)
    n = n.cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(i.alias(idx_name), F.get(arr, 2 * i).alias(key_name),
                           F.get(arr, 2 * i + 1).alias(value_name)))
    return F.when(n > 0, pairs)


def explode_pairs(df: DataFrame, arr, keep: Sequence[str] | None = None,
                  keep_partial: bool = True, key_name: str = "minute",
                  value_name: str = "value", idx_name: str = "pair_idx") -> DataFrame:
    """One output row per (key, value) pair of ``arr``; ``keep`` columns ride along."""
    keep = list(keep) if keep is not None else [c for c in df.columns
                                                 if not (isinstance(arr, str) and c == arr)]
    pairs = pair_array(arr, keep_partial, key_name, value_name, idx_name)
    return df.select(*keep, F.inline(pairs))


def text_to_tokens(c) -> Column:
    """Comma text -> array<string>; JSON array text ('[...]') is parsed instead.

    Accepting both forms means a source that ships the history as a JSON
    array does not turn every token into a non-number.
    """
    c = _col(c)
    is_json = F.ltrim(c).startswith(F.lit("["))
    return F.when(is_json, F.from_json(c, "array<string>")).otherwise(F.split(c, ",", -1))


def _tag_channel(ch_name, name, key_name, value_name):
    def tag(p):
        return F.struct(F.lit(ch_name).alias(name), p["pair_idx"].alias("pair_idx"),
                        p[key_name].alias(key_name), p[value_name].alias(value_name))
    return tag


def channel_array(csv, channels: Iterable[tuple[str, int]] = PRICE_CHANNELS, keep_partial: bool = True,
                  name: str = "channel", key_name: str = "minute", value_name: str = "value") -> Column:
    """The (channel, pair) structs of the selected channels as one array."""
    csv = _col(csv)
    per_channel = []
    for ch_name, idx in channels:
        pairs = pair_array(F.get(csv, F.lit(idx)), keep_partial, key_name, value_name)
        per_channel.append(F.transform(pairs, _tag_channel(ch_name, name, key_name, value_name)))
    # NULL (absent or empty) channels are dropped: ``flatten`` is NULL if any part is.
    return F.flatten(F.array_compact(F.array(*per_channel)))


def explode_channels(df: DataFrame, csv, channels: Iterable[tuple[str, int]] = PRICE_CHANNELS,
                     keep: Sequence[str] | None = None, keep_partial: bool = True,
                     name: str = "channel", key_name: str = "minute",
                     value_name: str = "value") -> DataFrame:
    """One row per (channel, pair) of the selected channels, decoded in-row."""
    keep = list(keep) if keep is not None else [c for c in df.columns
                                                 if not (isinstance(csv, str) and c == csv)]
    return df.select(*keep, F.inline(channel_array(csv, channels, keep_partial, name, key_name, value_name)))
