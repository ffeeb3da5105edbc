from starloom.functions.calendar import (
    calendar_attributes,
    calendar_key,
    fiscal_attributes,
    year_quarter,
)
from starloom.functions.numbers import convert_number, to_number

__all__ = [
    "calendar_attributes",
    "calendar_key",
    "convert_number",
    "fiscal_attributes",
    "to_number",
    "year_quarter",
]
