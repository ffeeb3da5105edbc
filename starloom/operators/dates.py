"""The date dimension: one row per day of an inclusive range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import calendar_attributes, fiscal_attributes

DAYS_PER_PARTITION = 50_000

# Names, order, types and nullability of the columns.
DATE_DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("date_key", T.IntegerType(), False),
        T.StructField("full_date", T.DateType(), True),
        T.StructField("date_name", T.StringType(), False),
        T.StructField("date_name_us", T.StringType(), False),
        T.StructField("date_name_eu", T.StringType(), False),
        T.StructField("day_of_week", T.ByteType(), False),
        T.StructField("day_name_of_week", T.StringType(), False),
        T.StructField("day_of_month", T.ByteType(), False),
        T.StructField("day_of_year", T.ShortType(), False),
        T.StructField("weekday_weekend", T.StringType(), False),
        T.StructField("week_of_year", T.ByteType(), False),
        T.StructField("month_name", T.StringType(), False),
        T.StructField("month_of_year", T.ByteType(), False),
        T.StructField("is_last_day_of_month", T.StringType(), False),
        T.StructField("calendar_quarter", T.ByteType(), False),
        T.StructField("calendar_year", T.ShortType(), False),
        T.StructField("calendar_year_month", T.StringType(), False),
        T.StructField("calendar_year_qtr", T.StringType(), False),
        T.StructField("fiscal_month_of_year", T.ByteType(), False),
        T.StructField("fiscal_quarter", T.ByteType(), False),
        T.StructField("fiscal_year", T.IntegerType(), False),
        T.StructField("fiscal_year_month", T.StringType(), False),
        T.StructField("fiscal_year_qtr", T.StringType(), False),
    ]
)


def _as_time(value: dt.date | str) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime.combine(value, dt.time())
    return dt.datetime.fromisoformat(value.replace("/", "-"))


def date_dimension(
    spark: SparkSession,
    begin: dt.date | str,
    end: dt.date | str,
    fiscal_months_offset: int = 6,
) -> DataFrame:
    """Days from ``begin`` to ``end`` with calendar and fiscal attributes.

    Both ends are included; a reversed range gives no rows. With a time of day,
    the days counted from ``begin`` end at the last one not after ``end``.
    """
    first, last = _as_time(begin), _as_time(end)
    days = max(0, (last - first).days + 1)
    day = F.col("day")
    attributes = calendar_attributes(day) | fiscal_attributes(day, fiscal_months_offset)
    start = F.lit(first.date().isoformat()).cast("date")
    return (
        spark.range(0, days, 1, numPartitions=1 + days // DAYS_PER_PARTITION)
        .select(F.date_add(start, F.col("id").cast("int")).alias("day"))
        .select(*[column.alias(name) for name, column in attributes.items()])
    )


def date_span(df: DataFrame, column: str) -> tuple[dt.date, dt.date] | None:
    """First and last day found in ``column``, or None if it holds no value."""
    day = F.to_date(column)
    first, last = df.agg(F.min(day), F.max(day)).first()
    return None if first is None else (first, last)
