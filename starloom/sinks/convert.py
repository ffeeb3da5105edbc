"""Conversion of any source format to any target format."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.names import quoted
from starloom.sinks.json import (
    codec_for,
    write_json_array,
    write_json_lines,
    write_json_split,
)
from starloom.sources import (
    read_csv_text,
    read_csv_typed,
    read_json_array,
    read_json_lines,
    read_json_split,
)


NESTED = (T.StructType, T.ArrayType, T.MapType)


def _only(options: Mapping[str, object] | None, *known: str) -> dict:
    """The options, of which each must have a meaning here."""
    unknown = set(options or {}) - set(known)
    if unknown:
        raise ValueError(f"options that do not apply: {sorted(unknown)}; there are {known}")
    return dict(options or {})


def read_any(
    spark: SparkSession,
    source: str,
    format: str,
    schema: str | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Read ``csv``, ``json``, ``json_array``, ``json_split``, ``parquet``, ``table`` or ``jdbc``.

    Nothing is dropped on the way: broken lines, surplus fields and unknown columns are errors,
    and in CSV an empty field is null, a quoted one an empty text. CSV without a schema is text
    throughout. ``options`` are ``missing`` for CSV, ``mode`` for JSON lines,
    and for ``jdbc``, whose source is the table or aliased query, those of the connection. An
    option, or a schema, that does not apply is an error.
    """
    if schema is not None and format in ("parquet", "table", "jdbc"):
        raise ValueError(f"{format} has a schema of its own")
    if format == "csv":
        given = _only(options, "missing")
        if schema is None:
            return read_csv_text(spark, source, empty_is_null=True)
        return read_csv_typed(spark, source, schema, given.get("missing", ()))
    if format == "json":
        mode = _only(options, "mode").get("mode", "FAILFAST")
        return read_json_lines(spark, source, schema, mode)
    if format == "jdbc":
        return spark.read.format("jdbc").options(**(options or {})).option("dbtable", source).load()
    _only(options)
    if format == "json_array":
        return read_json_array(spark, source, schema)
    if format == "json_split":
        if schema is None:
            raise ValueError("json_split needs a schema")
        return read_json_split(spark, source, schema)
    if format == "parquet":
        return spark.read.parquet(source)
    if format == "table":
        return spark.table(source)
    raise ValueError(f"unknown source format: {format}")


def write_csv(
    df: DataFrame,
    path: str,
    rows_per_file: int = 1_000_000,
    mode: str = "errorifexists",
    compression: str = "infer",
) -> None:
    """CSV with a header, quotes doubled inside quoted fields, blanks kept.

    A null is an empty field and an empty text a quoted one. Nested columns are written as JSON
    text. Files are bounded.
    """

    def flat(field: T.StructField) -> Column:
        value = F.col(quoted(field.name))
        if isinstance(field.dataType, NESTED):
            value = F.to_json(value, {"ignoreNullFields": "false"})
        return value.alias(field.name)

    (
        df.select(*[flat(field) for field in df.schema.fields])
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", codec_for(path, compression))
        .csv(path)
    )


def write_any(
    df: DataFrame,
    target: str,
    format: str,
    mode: str = "errorifexists",
    options: Mapping[str, object] | None = None,
) -> None:
    """Write in any of the formats of :func:`read_any`.

    ``options`` are the arguments of the format's writer, such as ``rows_per_file`` and
    ``compression``, or for ``jdbc`` those of the connection; others are errors.
    """
    if format == "csv":
        write_csv(df, target, mode=mode, **_only(options, "rows_per_file", "compression"))
    elif format == "json":
        write_json_lines(df, target, mode=mode, **_only(options, "compression"))
    elif format == "json_array":
        known = ("pretty", "compression", "rows_per_file", "bytes_per_file")
        write_json_array(df, target, mode=mode, **_only(options, *known))
    elif format == "json_split":
        known = ("compression", "rows_per_document")
        write_json_split(df, target, mode=mode, **_only(options, *known))
    elif format == "parquet":
        df.write.mode(mode).options(**_only(options, "compression")).parquet(target)
    elif format == "table":
        provider = _only(options, "format").get("format", "parquet")
        df.write.mode(mode).format(provider).saveAsTable(target)
    elif format == "jdbc":
        writer = df.write.format("jdbc").options(**(options or {})).option("dbtable", target)
        writer.mode(mode).save()
    else:
        raise ValueError(f"unknown target format: {format}")


def convert(
    spark: SparkSession,
    source: str,
    source_format: str,
    target: str,
    target_format: str,
    schema: str | None = None,
    mode: str = "errorifexists",
    source_options: Mapping[str, object] | None = None,
    target_options: Mapping[str, object] | None = None,
) -> None:
    """Read one format and write another, without passing rows through the driver."""
    rows = read_any(spark, source, source_format, schema, source_options)
    write_any(rows, target, target_format, mode, target_options)
