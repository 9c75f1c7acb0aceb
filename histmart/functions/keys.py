"""Surrogate keys: md5 over '|'-joined text parts.

``concat`` propagates NULL exactly like the warehouse ``||`` operator, so a
key with a NULL part is NULL unless a ``null_token`` is given; ``concat_ws``
would silently skip NULL parts and must not be used here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms used inside keys, equal to the warehouse defaults.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"      # to_varchar(timestamp)
TS_TEXT_ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssSSS"   # to_char(ts, 'YYYY-MM-DD"T"HH24:MI:SSFF3')
KEY_SEPARATOR = "|"
NULL_TOKEN = "NULL"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_text(c) -> Column:
    """Timestamp as text with fixed milliseconds ('2011-01-01 00:00:00.000')."""
    return F.date_format(_col(c), TS_TEXT_FORMAT)


def ts_text_iso(c) -> Column:
    return F.date_format(_col(c), TS_TEXT_ISO_FORMAT)


def as_text(c) -> Column:
    """Numbers, dates and strings as text (date -> 'yyyy-MM-dd')."""
    return _col(c).cast("string")


def surrogate_key(*parts, null_token: str | None = None) -> Column:
    """md5 of the parts joined by '|'.

    Parts are column names or Columns that are already text (wrap timestamps
    in ``ts_text``). With ``null_token`` every NULL part becomes that token.
    """
    cols = []
    for i, p in enumerate(parts):
        c = as_text(p) if isinstance(p, str) else p
        if null_token is not None:
            c = F.coalesce(c, F.lit(null_token))
        if i:
            cols.append(F.lit(KEY_SEPARATOR))
        cols.append(c)
    return F.md5(F.concat(*cols))
