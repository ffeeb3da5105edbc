from starloom.sinks.convert import convert, read_any, write_any, write_csv
from starloom.sinks.json import (
    csv_to_json,
    write_json_array,
    write_json_lines,
    write_json_split,
)
from starloom.sinks.tables import (
    append_once,
    create_database,
    drop_database,
    load_database_table,
    load_table,
    primary_key_statement,
    recreate_table,
    write_by_key,
)
from starloom.sinks.versions import restore

__all__ = [
    "append_once",
    "convert",
    "create_database",
    "csv_to_json",
    "drop_database",
    "load_database_table",
    "load_table",
    "primary_key_statement",
    "read_any",
    "recreate_table",
    "restore",
    "write_any",
    "write_by_key",
    "write_csv",
    "write_json_array",
    "write_json_lines",
    "write_json_split",
]
