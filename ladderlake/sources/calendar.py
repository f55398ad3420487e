"""Generated sources: the calendar, weekly windows and weekly file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.functions.columns import as_column

# Range of the standard calendar, name of a weekly window.
CALENDAR_START, CALENDAR_END = "2020-01-01", "2029-12-31"
DAY_FORMAT = "yyyy-MM-dd"


def calendar_of(days: DataFrame, day: str = "date") -> DataFrame:
    """Calendar attributes of a column of dates; Monday is weekday 0."""
    d = F.col(day)
    return days.select(
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekday(d).alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def calendar_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar of every day from `start` to `end` of a one-row frame."""
    return calendar_of(bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date")))


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(
        F.to_date(F.lit(start)).alias("start"), F.to_date(F.lit(end)).alias("end")
    )
    return calendar_between(bounds, "start", "end")


def weekly_windows(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Explode each date range into the Sunday..Saturday weeks wholly inside it.

    Adds `dated` (the Sunday) and `query_str` (`<sunday>_<saturday>`); a range without
    a whole week yields no row. The other columns are kept.
    """
    first = F.next_day(F.date_sub(F.col(start), 1), "SU")
    last_saturday = F.next_day(F.date_sub(F.col(end), 7), "SA")
    week = F.expr("interval 7 day")
    sundays = F.when(first <= last_saturday, F.sequence(first, last_saturday, week))
    return ranges.withColumn("dated", F.explode(sundays)).withColumn(
        "query_str", window_label("dated")
    )


def window_label(sunday: str | Column) -> Column:
    sunday = as_column(sunday)
    return F.concat_ws(
        "_",
        F.date_format(sunday, DAY_FORMAT),
        F.date_format(F.date_add(sunday, 6), DAY_FORMAT),
    )


def weekly_paths(windows: DataFrame, extract: str) -> DataFrame:
    """`file_date` and relative `endpoint_str` of each weekly window's file."""
    return windows.withColumns(
        {
            "file_date": F.date_format("dated", DAY_FORMAT),
            "endpoint_str": F.concat(F.col("query_str"), F.lit(f"/{extract}.parquet")),
        }
    ).drop("dated", "query_str")
