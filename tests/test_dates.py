from __future__ import annotations

import calendar
import datetime as dt

import pytest

from starloom.operators import (
    DATE_DIMENSION_SCHEMA,
    KeyViolation,
    check_primary_key,
    date_dimension,
    date_span,
    first_rows,
)
from starloom.sinks import load_table, recreate_table


def shift_months(day: dt.date, months: int) -> dt.date:
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return dt.date(year, month + 1, min(day.day, last))


def expected_row(day: dt.date, offset: int = 6) -> tuple:
    fiscal = shift_months(day, offset)
    return (
        day.year * 10000 + day.month * 100 + day.day,
        day,
        f"{day:%Y/%m/%d}",
        f"{day:%m/%d/%Y}",
        f"{day:%d/%m/%Y}",
        day.isoweekday() % 7 + 1,
        calendar.day_name[day.weekday()],
        day.day,
        day.timetuple().tm_yday,
        "Weekend" if day.weekday() >= 5 else "Weekday",
        day.isocalendar().week,
        calendar.month_name[day.month],
        day.month,
        "Y" if (day + dt.timedelta(days=1)).month != day.month else "N",
        (day.month - 1) // 3 + 1,
        day.year,
        f"{day:%Y-%m}",
        f"{day.year}Q{(day.month - 1) // 3 + 1}",
        fiscal.month,
        (fiscal.month - 1) // 3 + 1,
        fiscal.year,
        f"{fiscal:%Y-%m}",
        f"{fiscal.year}Q{(fiscal.month - 1) // 3 + 1}",
    )


def test_every_day_of_eleven_years(spark):
    rows = date_dimension(spark, "2000/01/01", "2010/12/31").orderBy("date_key").collect()
    assert len(rows) == 4018
    first = dt.date(2000, 1, 1)
    assert [tuple(row) for row in rows] == [
        expected_row(first + dt.timedelta(days=i)) for i in range(4018)
    ]


def test_golden_rows(spark):
    rows = date_dimension(spark, "2010-12-31", "2010-12-31").collect()
    text = " ".join(str(value) for value in rows[0])
    assert text == (
        "20101231 2010-12-31 2010/12/31 12/31/2010 31/12/2010 6 Friday 31 365 Weekday 52 "
        "December 12 Y 4 2010 2010-12 2010Q4 6 2 2011 2011-06 2011Q2"
    )


@pytest.mark.parametrize("offset", [-18, -6, 0, 1, 6, 12])
def test_fiscal_offsets_at_month_ends(spark, offset):
    rows = date_dimension(spark, "2008-01-28", "2009-03-02", offset).collect()
    assert {tuple(row) for row in rows} == {
        expected_row(row.full_date, offset) for row in rows
    }


def test_month_end_shift_is_clamped(spark):
    day = date_dimension(spark, "2009-08-31", "2009-08-31").first()
    assert (day.fiscal_year_month, day.fiscal_year_qtr) == ("2010-02", "2010Q1")


def test_iso_week_and_leap_day(spark):
    assert date_dimension(spark, "2010-01-01", "2010-01-01").first().week_of_year == 53
    assert date_dimension(spark, "2000-02-29", "2000-02-29").first().is_last_day_of_month == "Y"


def test_reversed_range_is_empty(spark):
    days = date_dimension(spark, "2010-12-31", "2000-01-01")
    assert days.count() == 0
    assert days.columns == DATE_DIMENSION_SCHEMA.fieldNames()


def test_times_of_day(spark):
    begin = dt.datetime(2000, 1, 1, 12)
    assert date_dimension(spark, begin, "2000-01-03").count() == 2
    assert date_dimension(spark, begin, dt.datetime(2000, 1, 3, 12)).count() == 3
    assert date_dimension(spark, begin, dt.date(2000, 1, 1)).count() == 0


def test_types(spark):
    days = date_dimension(spark, "2000-01-01", "2000-01-02")
    assert [f.dataType for f in days.schema] == [f.dataType for f in DATE_DIMENSION_SCHEMA]


def test_partitions_grow_with_the_range(spark):
    assert date_dimension(spark, "2000-01-01", "2000-12-31").rdd.getNumPartitions() == 1
    assert date_dimension(spark, "0001-01-01", "1000-01-01").rdd.getNumPartitions() == 8


def test_extension_rejects_overlap(spark, database):
    table = f"{database}.dim_date"
    recreate_table(spark, table, DATE_DIMENSION_SCHEMA)
    load_table(date_dimension(spark, "2000-01-01", "2000-12-31"), table, "date_key", "update")
    load_table(date_dimension(spark, "2001-01-01", "2001-12-31"), table, "date_key", "update")
    with pytest.raises(KeyViolation):
        load_table(date_dimension(spark, "2001-12-31", "2002-01-05"), table, "date_key", "update")
    assert spark.table(table).count() == 366 + 365
    check_primary_key(spark.table(table), "date_key")
    assert [row.date_key for row in first_rows(spark.table(table), "date_key", 20).collect()] == [
        20000101 + i for i in range(20)
    ]


def test_span(spark):
    days = spark.createDataFrame(
        [(dt.datetime(2001, 5, 1, 13),), (None,), (dt.datetime(1999, 1, 2),)], "at timestamp"
    )
    assert date_span(days, "at") == (dt.date(1999, 1, 2), dt.date(2001, 5, 1))
    assert date_span(days.where("at is null"), "at") is None
