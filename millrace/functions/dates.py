"""Calendar arithmetic as column expressions, and a calendar table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import quoted

# The date layouts tasks use.
DAY_FORMAT = "yyyyMMdd"
MONTH_FORMAT = "yyyyMM"
YEAR_FORMAT = "yyyy"
ISO_DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"

_INTERVAL_UNITS = ("years", "months", "weeks", "days", "hours", "mins", "secs")


def plus_days(day: Column, n: int) -> Column:
    return F.date_add(day, n)


def previous_day(day: Column) -> Column:
    return plus_days(day, -1)


def plus_months(day: Column, n: int) -> Column:
    """Same day ``n`` months on; the last day where the month is shorter."""
    return F.add_months(day, n)


def previous_month(day: Column) -> Column:
    return plus_months(day, -1)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def shift(moment: Column, unit: str, n: int) -> Column:
    """Add ``n`` calendar units to a timestamp (``years`` ... ``secs``)."""
    if unit not in _INTERVAL_UNITS:
        raise ValueError(f"unit {unit!r} is not one of {', '.join(_INTERVAL_UNITS)}")
    return moment + F.make_interval(**{unit: F.lit(n)})


def first_of_month(day: Column) -> Column:
    return F.trunc(day, "month")


def last_of_month(day: Column) -> Column:
    return F.last_day(day)


def first_of_year(day: Column) -> Column:
    return F.trunc(day, "year")


def last_of_year(day: Column) -> Column:
    return F.date_add(F.add_months(F.trunc(day, "year"), 12), -1)


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def weekday(day: Column) -> Column:
    """Day of the week with Sunday as 0."""
    return F.dayofweek(day) - 1


def is_month_end(day: Column) -> Column:
    return day.cast("date") == F.last_day(day)


def is_quarter_end(day: Column) -> Column:
    return is_month_end(day) & (F.month(day) % 3 == 0)


def parse_day(text: Column, layout: str = DAY_FORMAT) -> Column:
    """A date out of text; NULL where the text does not fit the layout."""
    return F.try_to_timestamp(text, F.lit(layout)).cast("date")


def parse_moment(text: Column, layout: str = SECOND_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(layout))


def with_date_columns(df: DataFrame, column: str) -> DataFrame:
    """Add the calendar attributes of a date or timestamp column."""
    day = quoted(column).cast("date")
    wd = weekday(day)
    return df.withColumns(
        {
            "day_text": F.date_format(day, DAY_FORMAT),
            "month_text": F.date_format(day, MONTH_FORMAT),
            "year_text": F.date_format(day, YEAR_FORMAT),
            "day_before": previous_day(day),
            "month_before": previous_month(day),
            "month_first": first_of_month(day),
            "month_last": last_of_month(day),
            "year_first": first_of_year(day),
            "year_last": last_of_year(day),
            "month_days": days_in_month(day),
            "week_day": wd,
            "is_monday": wd == 1,
            "is_thursday": wd == 4,
            "is_friday": wd == 5,
            "is_sunday": wd == 0,
            "is_month_end": is_month_end(day),
            "is_quarter_end": is_quarter_end(day),
        }
    )


def date_series(bounds: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """Every day from ``start`` to ``end`` of each row, both included."""
    first, last = F.col(start), F.col(end)
    days = F.when(first <= last, F.sequence(first, last))
    return bounds.select(F.explode(days).alias(name))


def date_dim(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """A calendar table: one row per day between the two columns of ``bounds``."""
    return with_date_columns(date_series(bounds, start, end), "day")
