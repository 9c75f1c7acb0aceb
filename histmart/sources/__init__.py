"""Sources (NDJSON raw load, driver tables) and sinks (overwrite/append/upsert)."""

from histmart.sources.raw import (
    table, spread, read_ndjson_lines, parse_raw, read_ndjson, read_json_array, load_status,
    RAW_FILE_PATTERN, DRIVER_TABLES,
)
from histmart.sources.sink import (
    layer_path, table_exists, create_view, overwrite, append, high_water, increment_filter, upsert, replace_table,
    replace_partitions, LAYERS,
)

__all__ = [
    "table", "spread", "read_ndjson_lines", "parse_raw", "read_ndjson", "read_json_array", "load_status",
    "RAW_FILE_PATTERN", "DRIVER_TABLES",
    "layer_path", "table_exists", "create_view", "overwrite", "append", "high_water", "increment_filter",
    "upsert", "replace_table", "replace_partitions", "LAYERS",
]
