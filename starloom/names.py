"""Column and table names as Spark is given them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str | Column) -> Column:
    """A column by its name, which may hold dots or be quoted; a column as it is."""
    if not isinstance(name, str):
        return name
    return F.col(name if name.startswith("`") and name.endswith("`") else quoted(name))


def parts_of(table: str) -> list[str]:
    """The names that a table's name is made of, without quotes."""
    found = re.findall(r"`(?:[^`]|``)*`|[^.`]+", table)
    return [x[1:-1].replace("``", "`") if x.startswith("`") else x for x in found]


def sibling(table: str, suffix: str) -> str:
    """The name of a table beside ``table``, in the same database."""
    *outer, last = parts_of(table)
    return ".".join(map(quoted, [*outer, last + suffix]))
