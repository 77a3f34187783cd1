"""Sources and sinks: JSON rows into staging tables, typed tables, JSON out."""

from stationday.sources.json_rows import (
    LoadSpec,
    load_all,
    load_json_rows,
    read_json_array_files,
    read_json_lines,
)
from stationday.sources.sink import write_json_lines
from stationday.sources.tables import (
    append_table,
    comment_table,
    drop_table,
    empty_from_schema,
    empty_like,
    ensure_database,
    ensure_table,
    overwrite_partitions,
    overwrite_table,
    table_exists,
)

__all__ = [
    "LoadSpec", "load_all", "load_json_rows", "read_json_array_files", "read_json_lines",
    "write_json_lines", "append_table", "comment_table", "drop_table", "empty_from_schema",
    "empty_like", "ensure_database", "ensure_table", "overwrite_partitions", "overwrite_table",
    "table_exists",
]
