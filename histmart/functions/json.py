"""Path extraction from JSON text or VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_path(c, path: str, dtype: str) -> Column:
    """Typed value at ``path`` ('$.a.b', case-exact) of JSON text or a VARIANT.

    Text is parsed tolerantly (invalid JSON -> NULL); a value that does not
    fit ``dtype`` is NULL rather than an error.
    """
    c = _col(c)
    return F.try_variant_get(F.try_parse_json(c.cast("string")), path, dtype)


def variant_path(v, path: str, dtype: str) -> Column:
    return F.try_variant_get(_col(v), path, dtype)


def json_text(v, path: str = "$") -> Column:
    """Sub-document at ``path`` as JSON text (arrays/objects) or plain text."""
    return F.try_variant_get(_col(v), path, "string")
