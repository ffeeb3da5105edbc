"""Calendar and fiscal attributes of a date, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_key(day: Column) -> Column:
    """The yyyymmdd number of a date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("int")


def year_quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Columns that depend on the calendar date alone, in table order."""
    on_weekend = F.dayofweek(day).isin(1, 7)
    return {
        "date_key": calendar_key(day),
        "full_date": day,
        "date_name": F.date_format(day, "yyyy/MM/dd"),
        "date_name_us": F.date_format(day, "MM/dd/yyyy"),
        "date_name_eu": F.date_format(day, "dd/MM/yyyy"),
        "day_of_week": F.dayofweek(day).cast("tinyint"),
        "day_name_of_week": F.date_format(day, "EEEE"),
        "day_of_month": F.day(day).cast("tinyint"),
        "day_of_year": F.dayofyear(day).cast("smallint"),
        "weekday_weekend": F.when(on_weekend, "Weekend").otherwise("Weekday"),
        "week_of_year": F.weekofyear(day).cast("tinyint"),
        "month_name": F.date_format(day, "MMMM"),
        "month_of_year": F.month(day).cast("tinyint"),
        "is_last_day_of_month": F.when(day == F.last_day(day), "Y").otherwise("N"),
        "calendar_quarter": F.quarter(day).cast("tinyint"),
        "calendar_year": F.year(day).cast("smallint"),
        "calendar_year_month": F.date_format(day, "yyyy-MM"),
        "calendar_year_qtr": year_quarter(day),
    }


def fiscal_attributes(day: Column, months_offset: int) -> dict[str, Column]:
    """Columns of the fiscal calendar, which runs ``months_offset`` months ahead.

    A negative offset lags behind. Days past the end of the shifted month fall
    on its last day.
    """
    shifted = F.add_months(day, months_offset)
    return {
        "fiscal_month_of_year": F.month(shifted).cast("tinyint"),
        "fiscal_quarter": F.quarter(shifted).cast("tinyint"),
        "fiscal_year": F.year(shifted),
        "fiscal_year_month": F.date_format(shifted, "yyyy-MM"),
        "fiscal_year_qtr": year_quarter(shifted),
    }
