from starloom.sources.csv import read_csv_text, read_csv_typed
from starloom.sources.documents import append_documents, read_collection, replace_collections
from starloom.sources.jdbc import (
    Ranges,
    as_relation,
    create_foreign_table,
    read_database,
    read_query,
)
from starloom.sources.json import (
    EVENT_SCHEMA,
    read_json_array,
    read_json_lines,
    read_json_split,
    stream_json_lines,
    stream_table,
)
from starloom.sources.tables import read_table

__all__ = [
    "EVENT_SCHEMA",
    "Ranges",
    "append_documents",
    "as_relation",
    "create_foreign_table",
    "read_collection",
    "read_csv_text",
    "read_csv_typed",
    "read_database",
    "read_json_array",
    "read_json_lines",
    "read_json_split",
    "read_query",
    "read_table",
    "replace_collections",
    "stream_json_lines",
    "stream_table",
]
