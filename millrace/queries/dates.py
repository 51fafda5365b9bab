"""Calendar arithmetic on the dates of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import dates as d
from millrace.queries.base import query, table

_CALENDAR = """
    strftime(day, '%Y%m%d') AS day_text, strftime(day, '%Y%m') AS month_text, strftime(day, '%Y') AS year_text,
    day - 1 AS day_before, CAST(day - INTERVAL 1 MONTH AS DATE) AS month_before,
    CAST(date_trunc('month', day) AS DATE) AS month_first, last_day(day) AS month_last,
    CAST(date_trunc('year', day) AS DATE) AS year_first,
    CAST(date_trunc('year', day) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_last,
    CAST(dayofmonth(last_day(day)) AS INTEGER) AS month_days, CAST(dayofweek(day) AS INTEGER) AS week_day,
    dayofweek(day) = 1 AS is_monday, dayofweek(day) = 4 AS is_thursday, dayofweek(day) = 5 AS is_friday,
    dayofweek(day) = 0 AS is_sunday, day = last_day(day) AS is_month_end,
    day = last_day(day) AND month(day) % 3 = 0 AS is_quarter_end
"""


@query(
    "date_dim",
    f"""
    WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
         days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
                  AS day FROM b),
         n AS (SELECT CAST(o_orderdate AS DATE) AS order_day, count(*) AS n FROM orders GROUP BY 1)
    SELECT day, {_CALENDAR}, coalesce(n, 0) AS orders FROM days LEFT JOIN n ON day = order_day
    """,
)
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar over all order dates, with the orders of each day."""
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders")
    bounds = orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    per_day = orders.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    calendar = d.date_dim(bounds, "lo", "hi").join(per_day, "day", "left")
    return calendar.withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(
    "date_columns",
    f"""
    SELECT o_orderkey, day, {_CALENDAR} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
    """,
)
def date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_orderdate as date) as day")
    return d.with_date_columns(orders, "day")


@query(
    "date_shift",
    """
    SELECT event_id, ts + INTERVAL 90 MINUTE AS minutes_on, ts - INTERVAL 2 YEAR AS years_back,
           ts + INTERVAL 3 WEEK AS weeks_on, CAST(CAST(ts AS DATE) + INTERVAL 5 MONTH AS DATE) AS months_on,
           CAST(ts AS DATE) + 40 AS days_on, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days_since
    FROM events
    """,
)
def date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, day = F.col("ts"), F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        "event_id",
        d.shift(ts, "mins", 90).alias("minutes_on"),
        d.shift(ts, "years", -2).alias("years_back"),
        d.shift(ts, "weeks", 3).alias("weeks_on"),
        d.plus_months(day, 5).alias("months_on"),
        d.plus_days(day, 40).alias("days_on"),
        d.days_between(F.lit("2024-01-01").cast("date"), day).cast("bigint").alias("days_since"),
    )


@query(
    "date_formats",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso_day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second_text,
           CAST(ts AS DATE) AS parsed_day, date_trunc('second', ts) AS parsed_second, true AS unreadable_is_null
    FROM events
    """,
)
def date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    second_text = F.date_format(ts, d.SECOND_FORMAT)
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(ts, d.ISO_DAY_FORMAT).alias("iso_day"),
        second_text.alias("second_text"),
        d.parse_day(F.date_format(ts, d.DAY_FORMAT)).alias("parsed_day"),
        d.parse_moment(second_text).cast("timestamp_ntz").alias("parsed_second"),
        F.isnull(d.parse_day(F.concat("event_type", F.date_format(ts, d.YEAR_FORMAT)))).alias(
            "unreadable_is_null"
        ),
    )
