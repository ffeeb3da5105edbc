"""Letting statements and writes fail, one after the other."""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrameWriter, SparkSession
from pyspark.sql.catalog import Catalog


class Broken(Exception):
    """A failure that a test has planted."""


POINTS = [
    (SparkSession, "sql"),
    (Catalog, "createTable"),
    (Catalog, "refreshTable"),
    *((DataFrameWriter, name) for name in ("save", "json", "parquet", "text", "saveAsTable")),
]


@contextlib.contextmanager
def failing_at(number: int, after: bool):
    """The call of that number fails, before it has done its work or after.

    Yields a list that holds the calls, by name.
    """
    calls: list[str] = []
    originals = {(kind, name): getattr(kind, name) for kind, name in POINTS}
    depth = 0

    def wrapped(name, original):
        def call(self, *args, **kwargs):
            nonlocal depth
            if depth:
                return original(self, *args, **kwargs)
            calls.append(name)
            broken = len(calls) == number + 1
            if broken and not after:
                raise Broken(name)
            depth += 1
            try:
                result = original(self, *args, **kwargs)
            finally:
                depth -= 1
            if broken:
                raise Broken(name)
            return result

        return call

    for (kind, name), original in originals.items():
        setattr(kind, name, wrapped(name, original))
    try:
        yield calls
    finally:
        for (kind, name), original in originals.items():
            setattr(kind, name, original)


def try_each(action, check, most: int = 60) -> int:
    """Let ``action`` fail at each of its calls in turn; ``check`` is called after each failure.

    Returns how many calls there were.
    """
    for after in (False, True):
        for number in range(most):
            with failing_at(number, after) as calls:
                try:
                    action()
                    failed = False
                except Broken:
                    failed = True
            check(failed)
            if len(calls) <= number:
                break
        else:
            raise AssertionError("more calls than expected")
    return number
