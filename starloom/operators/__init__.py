from starloom.operators.dates import DATE_DIMENSION_SCHEMA, date_dimension, date_span
from starloom.operators.keys import (
    KeyViolation,
    add_date_key,
    add_row_number,
    check_new_keys,
    check_primary_key,
    grow_keys,
    keep_first,
    key_violations,
)
from starloom.operators.merge import merge
from starloom.operators.shape import (
    coerce_numbers,
    count_by,
    drop_columns,
    first_rows,
    ingestion_summary,
    insert_first,
    move_to_front,
    with_audit_columns,
)

__all__ = [
    "DATE_DIMENSION_SCHEMA",
    "KeyViolation",
    "add_date_key",
    "add_row_number",
    "check_new_keys",
    "check_primary_key",
    "coerce_numbers",
    "count_by",
    "date_dimension",
    "date_span",
    "drop_columns",
    "first_rows",
    "grow_keys",
    "ingestion_summary",
    "insert_first",
    "keep_first",
    "key_violations",
    "merge",
    "move_to_front",
    "with_audit_columns",
]
