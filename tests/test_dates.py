import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions import dates as d


def one(spark, day, column):
    frame = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    return frame.select(column(F.col("d")).alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("function", "day", "expected"),
    [
        (d.previous_day, "2024-03-01", "2024-02-29"),
        (d.previous_month, "2024-03-31", "2024-02-29"),
        (d.first_of_month, "2023-02-14", "2023-02-01"),
        (d.last_of_month, "2023-02-14", "2023-02-28"),
        (d.first_of_year, "2024-07-09", "2024-01-01"),
        (d.last_of_year, "2024-07-09", "2024-12-31"),
        (d.days_in_month, "2024-02-10", 29),
        (d.weekday, "2024-06-02", 0),
        (d.weekday, "2024-06-08", 6),
        (d.is_month_end, "2023-02-28", True),
        (d.is_month_end, "2024-02-28", False),
        (d.is_month_end, "2024-02-29", True),
        (d.is_quarter_end, "2024-06-30", True),
        (d.is_quarter_end, "2024-06-29", False),
        (d.is_quarter_end, "2024-05-31", False),
    ],
)
def test_day(spark, function, day, expected):
    found = one(spark, day, function)
    assert (found.isoformat() if isinstance(found, dt.date) else found) == expected


def test_months_clamp(spark):
    assert one(spark, "2024-01-31", lambda c: d.plus_months(c, 1)) == dt.date(2024, 2, 29)
    assert one(spark, "2024-02-29", lambda c: d.plus_months(c, 12)) == dt.date(2025, 2, 28)


def test_shift(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 59, 30),)], "t timestamp_ntz")
    moves = {"secs": 45, "mins": -60, "hours": 1, "days": 1, "weeks": -1, "months": 1, "years": 1}
    row = df.select(*[d.shift(F.col("t"), u, n).alias(u) for u, n in moves.items()]).first()
    assert row["secs"] == dt.datetime(2024, 2, 1, 0, 0, 15)
    assert row["months"] == dt.datetime(2024, 2, 29, 23, 59, 30)
    assert row["weeks"] == dt.datetime(2024, 1, 24, 23, 59, 30)
    with pytest.raises(ValueError):
        d.shift(F.col("t"), "decades", 1)


def test_series(spark):
    bounds = spark.createDataFrame(
        [(dt.date(2024, 2, 28), dt.date(2024, 3, 1)), (dt.date(2024, 5, 2), dt.date(2024, 5, 1))], "a date, b date"
    )
    assert [r[0].isoformat() for r in rows(d.date_series(bounds, "a", "b"))] == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_parse(spark):
    df = spark.createDataFrame([("20240229",), ("20230229",), ("2024",), (None,)], "v string")
    found = [r["d"] for r in df.select(d.parse_day(F.col("v")).alias("d")).collect()]
    assert found == [dt.date(2024, 2, 29), None, None, None]
    month = df.limit(1).select(d.parse_day(F.lit("202405"), d.MONTH_FORMAT).alias("d")).first()["d"]
    assert month == dt.date(2024, 5, 1)
