"""Time helpers for minute-offset series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: series minutes count from this zone-free instant.
SERIES_EPOCH = "2011-01-01 00:00:00"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_to_ts(m) -> Column:
    """Minutes since 2011-01-01 -> TIMESTAMP_NTZ (zone independent).

    Non-integral or out-of-range input gives NULL instead of failing the job.
    """
    m = _col(m).try_cast("bigint")
    return F.timestamp_add("MINUTE", m, F.lit(SERIES_EPOCH).cast("timestamp_ntz"))


def ts_to_minutes(ts) -> Column:
    """Inverse of ``minutes_to_ts`` (whole minutes, floor)."""
    epoch = F.lit(SERIES_EPOCH).cast("timestamp_ntz")
    return F.timestamp_diff("MINUTE", epoch, _col(ts))


def month_start(ts) -> Column:
    """First day of the month as DATE."""
    return F.date_trunc("MONTH", _col(ts)).cast("date")
