from starloom.streaming.medallion import (
    Layout,
    bronze_view,
    clean_up,
    create_layout,
    gold_view,
    join_reference_data,
    silver_view,
    start_bronze,
    start_gold,
    start_silver,
)
from starloom.streaming.quarantine import (
    read_accepted,
    read_quarantined,
    start_with_quarantine,
    stream_checked_lines,
)
from starloom.streaming.sinks import (
    append_to_files,
    append_to_table,
    drop_versions,
    finish,
    replace_table,
    stop_all,
    wait_until_ready,
)

__all__ = [
    "Layout",
    "append_to_files",
    "append_to_table",
    "bronze_view",
    "clean_up",
    "create_layout",
    "drop_versions",
    "finish",
    "gold_view",
    "join_reference_data",
    "read_accepted",
    "read_quarantined",
    "replace_table",
    "silver_view",
    "start_bronze",
    "start_gold",
    "start_silver",
    "start_with_quarantine",
    "stop_all",
    "stream_checked_lines",
    "wait_until_ready",
]
