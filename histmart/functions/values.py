"""Value cleaning: sentinels, scaling, tolerant number parsing, range rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(c, divisor: float | int | None, dtype: str | None = None) -> Column:
    """Decimal division (cents -> dollars: divisor 100, tenths: 10)."""
    c = _col(c)
    if divisor is not None:
        c = c.cast("decimal(38,0)") / F.lit(divisor).cast("decimal(10,1)")
    return c.cast(dtype) if dtype else c


def sentinel_to_null(c, divisor=None, dtype: str | None = None) -> Column:
    """Negative values are 'no value' markers: NULL, else the (scaled) value."""
    c = _col(c)
    return F.when(c < 0, F.lit(None)).otherwise(scaled(c, divisor, dtype))


def sentinel_flag(c) -> Column:
    """1 when the raw value is a negative sentinel, else 0 (NULL -> 0)."""
    return F.when(_col(c) < 0, F.lit(1)).otherwise(F.lit(0))


def try_number(c) -> Column:
    """Tolerant text -> integral number: '1.5' -> 2, '[1' -> NULL."""
    return _col(c).try_cast("decimal(38,0)")


def in_price_band(p, upper=400) -> Column:
    """Keep sentinels (p < 0) and real values in (0, upper]; drop 0 and above."""
    p = _col(p)
    return (p < 0) | ((p > 0) & (p <= upper))


def nullif_empty(c) -> Column:
    return F.nullif(_col(c), F.lit(""))
