"""Column-level building blocks (all JVM-side expressions, no Python UDFs)."""

from histmart.functions.keys import surrogate_key, ts_text, ts_text_iso, as_text
from histmart.functions.time import minutes_to_ts, ts_to_minutes, month_start
from histmart.functions.json import json_path, variant_path, json_text
from histmart.functions.values import (
    sentinel_to_null, sentinel_flag, scaled, try_number, in_price_band, nullif_empty,
)

__all__ = [
    "surrogate_key", "ts_text", "ts_text_iso", "as_text",
    "minutes_to_ts", "ts_to_minutes", "month_start",
    "sentinel_to_null", "sentinel_flag", "scaled", "try_number", "in_price_band",
    "nullif_empty", "json_path", "variant_path", "json_text",
]
