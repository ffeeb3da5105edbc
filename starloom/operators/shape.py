"""Column and row shaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import convert_number, to_number
from starloom.names import quoted


def drop_columns(df: DataFrame, columns: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop columns; when ``strict``, a name that is not there is an error."""
    missing = [name for name in columns if name not in df.columns]
    if strict and missing:
        raise KeyError(f"no such columns: {missing}")
    return df.drop(*columns)


def move_to_front(df: DataFrame, column: str) -> DataFrame:
    if column not in df.columns:
        raise KeyError(f"no such column: {column}")
    others = [name for name in df.columns if name != column]
    return df.select(*[quoted(name) for name in [column, *others]])


def insert_first(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Add a column at position 0; an existing name is an error."""
    if column in df.columns:
        raise ValueError(f"column exists already: {column}")
    return df.select(value.alias(column), "*")


def coerce_numbers(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Turn columns into numbers, failing on text that is not a number.

    A column that is a number already is cast without going through text, and fails where the
    cast would change its value.
    """

    def number(name: str, data_type: str) -> Column:
        given = df.schema[name].dataType
        if isinstance(given, T.NumericType):
            return convert_number(F.col(quoted(name)), given, data_type)
        return to_number(F.col(quoted(name)), data_type)

    return df.select(
        *[
            number(name, types[name]).alias(name) if name in types else F.col(quoted(name))
            for name in df.columns
        ]
    )


def with_audit_columns(df: DataFrame) -> DataFrame:
    """Add when a row was received and which file it came from.

    ``df`` must be a scan of files, filtered or narrowed at most: behind a shuffle a row's file
    is not known, which is an error. A view of a stream hides its scan's metadata; there the
    file is the one that the task reads.
    """
    file = F.input_file_name() if df.isStreaming else F.col("_metadata.file_path")
    return df.select(
        "*", F.current_timestamp().alias("receipt_time"), file.alias("source_file")
    )


def first_rows(df: DataFrame, order_by: str | Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in the order of ``order_by``."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)


def count_by(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows per value of ``column``; the null group counts 0 as its values are null."""
    return df.groupBy(quoted(column)).agg(F.count(quoted(column)).alias(name))


def ingestion_summary(df: DataFrame) -> DataFrame:
    """One row: how many records and how many columns were read."""
    return df.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.lit(len(df.columns)).alias("column_count"),
    )
