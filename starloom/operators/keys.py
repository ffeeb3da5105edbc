"""Surrogate keys, first-row-per-key, and primary-key checks."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import calendar_key
from starloom.names import column, quoted
from starloom.operators.shape import insert_first
from starloom.scratch import drop_folder, scratch_path

# Fixed value: the sequential date key of the first row.
SEQUENTIAL_DATE_KEY_START = 20100101
#: A name and a number per file: some 20 MB.
BROADCAST_FILES = 200_000


class KeyViolation(ValueError):
    """A primary key is null, repeated, or present in the target already."""


def _names(columns: str | Sequence) -> list:
    return [columns] if isinstance(columns, str) else list(columns)


def _columns(columns: str | Sequence) -> list[Column]:
    return [column(name) for name in _names(columns)]


def _without_maps(value: Column, data_type: T.DataType) -> Column:
    """The value with every map as its sorted entries."""
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: _without_maps(x, data_type.elementType))
    if isinstance(data_type, T.StructType) and data_type.fields:
        parts = [_without_maps(value[f.name], f.dataType).alias(f.name) for f in data_type.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(data_type, T.MapType):
        entries = T.StructType().add("key", data_type.keyType).add("value", data_type.valueType)
        return F.array_sort(_without_maps(F.map_entries(value), T.ArrayType(entries)))
    return value


def _row_digest(df: DataFrame) -> Column:
    values = [_without_maps(column(f.name), f.dataType) for f in df.schema.fields]
    return F.xxhash64(F.lit(0), *values)


def _file_number(name: str) -> int:
    """The number of the partition that a part file was written from."""
    found = re.match(r"part-(\d+)-", name)
    if found is None:
        raise ValueError(f"the committer's file names do not tell their order: {name}")
    return int(found[1])


def _file_position(staged: DataFrame) -> DataFrame:
    """Staged rows with the name of their file and their place in it."""
    return staged.select(
        "*",
        F.col("_metadata.file_name").alias("__file"),
        F.col("_metadata.row_index").alias("__position"),
    )


def add_row_number(
    df: DataFrame,
    name: str,
    order_by: str | Sequence[str | Column],
    start: int = 1,
    unique_order: bool = False,
) -> DataFrame:
    """Put a gap-free number, counted in the order of ``order_by``, at position 0.

    The rows are copied once, as their ranges are sampled before they are read. The
    copy is range-partitioned on the order keys and written, each partition sorted
    to a file of its own, and then dropped. A row's number is its position in its
    file plus the rows of all files before it. The file sizes come from the footers;
    there are as many as shuffle partitions, and up to ``BROADCAST_FILES`` of them are
    broadcast. No task sees more than one range.

    Rows that tie on the order keys are told apart by a digest of the whole row,
    which makes the numbering repeatable, and equal rows by their place in the
    copy. So neither a hot key nor a group of equal rows falls to one task. Set
    ``unique_order`` where the order keys identify a row, which saves the digest.
    """
    keys = _names(order_by)
    if not keys:
        raise ValueError("numbering rows needs an order")
    if name in df.columns:
        raise ValueError(f"column exists already: {name}")
    spark = df.sparkSession
    source = scratch_path(spark, "copy")
    df.write.parquet(source)
    rows, order = spark.read.schema(df.schema).parquet(source), _columns(keys)
    if not unique_order:
        rows = _file_position(rows).withColumn("__digest", _row_digest(df))
        order += [F.col("__digest"), F.col("__file"), F.col("__position")]
    path = scratch_path(spark, "numbered")
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*[quoted(name) for name in df.columns])
        .write.option("maxRecordsPerFile", 0)
        .parquet(path)
    )
    drop_folder(spark, source)
    staged = _file_position(spark.read.schema(df.schema).parquet(path))

    sizes = staged.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes.sort(key=lambda row: _file_number(row["__file"]))
    before = accumulate((row.n for row in sizes), initial=0)
    offsets = spark.createDataFrame(
        [(row["__file"], offset) for row, offset in zip(sizes, before)],
        "`__file` string, `__offset` bigint",
    )
    number = F.col("__offset") + F.col("__position") + start
    if len(sizes) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return staged.join(offsets, "__file").select(
        number.alias(name), *[quoted(other) for other in df.columns]
    )


def grow_keys(
    df: DataFrame, existing: DataFrame | None, key: str, natural: str | Sequence[str]
) -> DataFrame:
    """All members of a dimension: those of ``df`` and those that ``existing`` alone has.

    ``existing`` has the members so far, with their numbers in column ``key``. A member that is
    known by its ``natural`` key keeps its number and takes the values of ``df``; new ones get
    the numbers above the highest so far, without gaps, in the order of their natural keys; one
    that ``df`` no longer has stays as it was, as facts may refer to it. Nothing is renumbered.
    A natural key that is null or repeated in ``df`` is an error. Columns are matched by name.
    """
    names = _names(natural)
    check_primary_key(df, names)
    if existing is None:
        return add_row_number(df, key, names, unique_order=True)
    columns = [key, *df.columns]
    if sorted(existing.columns) != sorted(columns):
        raise ValueError(f"columns {sorted(existing.columns)} are not {sorted(columns)}")
    on = [quoted(name) for name in names]
    highest = existing.agg(F.max(column(key))).first()[0] or 0
    numbered = existing.select(quoted(key), *on)
    known = df.join(numbered, names).select(*map(quoted, columns))
    fresh = df.join(numbered.select(*on), names, "left_anti")
    fresh = add_row_number(fresh, key, names, start=highest + 1, unique_order=True)
    gone = existing.join(df.select(*on), names, "left_anti").select(*map(quoted, columns))
    return known.unionByName(fresh).unionByName(gone)


def add_date_key(
    df: DataFrame,
    name: str = "date_key",
    mode: str = "sequential",
    row_number: str | None = None,
    day: str | None = None,
) -> DataFrame:
    """Put a date key at position 0.

    ``sequential`` counts up from 20100101 with the rows, so most keys are no
    calendar dates; it needs the ``row_number`` column, and is a bigint as the
    count has no bound. ``calendar`` is the yyyymmdd number of the ``day`` column.
    """
    if mode == "sequential":
        if row_number is None:
            raise ValueError("sequential date keys need row_number")
        value = column(row_number) + (SEQUENTIAL_DATE_KEY_START - 1)
    elif mode == "calendar":
        if day is None:
            raise ValueError("calendar date keys need day")
        value = calendar_key(column(day))
    else:
        raise ValueError(f"unknown date key mode: {mode}")
    return insert_first(df, name, value)


def keep_first(
    df: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str | Column]
) -> DataFrame:
    """The first row of every key in the order of ``order_by``; null keys are one group.

    Spark limits each group before the shuffle as well, so a hot key sends at
    most one row per map task.
    """
    order = _columns(order_by)
    if not order:
        raise ValueError("keeping the first row needs an order")
    rank = F.row_number().over(Window.partitionBy(*_columns(key)).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once, with the number of rows."""
    keys = _columns(key)
    is_null = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where(is_null | (F.col("row_count") > 1))


def check_primary_key(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise :class:`KeyViolation` unless ``key`` is unique and never null."""
    found = key_violations(df, key).take(5)
    if found:
        raise KeyViolation(f"null or repeated keys, e.g. {[tuple(row) for row in found]}")


#: So many new keys are listed to the scan, as many as Spark by default hands on one by one.
LISTED_KEYS = 10


def _may_hold(existing: DataFrame, df: DataFrame, names: list) -> DataFrame:
    """``existing`` without rows whose key lies outside the range of the new ones.

    The condition reaches the scan, where it is compared with the ranges that files keep of their
    columns, and a list of few keys with their Bloom filters, so files and row groups that hold
    none of the keys are not read.
    """
    simple = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    for name in names:
        kinds = {type(frame.select(column(name)).schema[0].dataType) for frame in (existing, df)}
        if len(kinds) != 1 or not issubclass(kinds.pop(), simple):
            continue
        least, most = df.agg(F.min(column(name)), F.max(column(name))).first()
        if least is None or least != least or most != most:
            continue
        existing = existing.where(column(name).between(F.lit(least), F.lit(most)))
    if len(names) == 1:
        listed = df.select(column(names[0]).alias("key")).limit(LISTED_KEYS + 1).collect()
        if len(listed) <= LISTED_KEYS and all(row.key is not None for row in listed):
            existing = existing.where(column(names[0]).isin([row.key for row in listed]))
    return existing


def check_new_keys(df: DataFrame, existing: DataFrame, key: str | Sequence[str]) -> None:
    """Raise :class:`KeyViolation` if a key of ``df`` is in ``existing`` already.

    Only what may hold a key of ``df`` is read: see :func:`starloom.sinks.write_by_key` for files
    whose ranges do not overlap. ``df`` is read twice more, its key columns only.
    """
    names = _names(key)
    keys = [column(k).alias(f"key_{place}") for place, k in enumerate(names)]
    aliases = [f"key_{place}" for place in range(len(keys))]
    held = _may_hold(existing, df, names).select(*keys)
    found = held.join(df.select(*keys), aliases, "left_semi").take(5)
    if found:
        raise KeyViolation(f"keys present already, e.g. {[tuple(row) for row in found]}")
