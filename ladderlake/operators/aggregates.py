"""Aggregations behind the views and their roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderlake.functions.columns import percentage, win_flag


def lineups(fact: DataFrame) -> DataFrame:
    """One row per match and civ: how many players chose it and how many of them won.

    Both civ views start here. Spark combines before the shuffle, so a match that holds
    a large share of all rows costs each task at most one row per civ, and from here on
    distinct matches are plain row counts.
    """
    return fact.groupBy("match_fk", "civ_fk").agg(
        F.count(F.lit(1)).alias("players"), F.sum(win_flag("winner")).alias("wins")
    )


def with_percentage(df: DataFrame, alias: str = "win_percentage") -> DataFrame:
    return df.withColumn(alias, percentage("wins", "matches_played"))


def matches_and_wins(df: DataFrame, *by: str) -> DataFrame:
    """Totals of rows that stand for one match each."""
    totals = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("matches_played"), F.sum("wins").alias("wins")
    )
    return with_percentage(totals)


def roll_up(view: DataFrame, *by: str) -> DataFrame:
    """Re-aggregate a view to fewer dimensions; percentages are recomputed, not averaged."""
    totals = view.groupBy(*by).agg(
        F.sum("matches_played").alias("matches_played"), F.sum("wins").alias("wins")
    )
    return with_percentage(totals)


def last_updated(df: DataFrame, loaded: str = "ldts") -> DataFrame:
    """Latest load time as text, such as `2024-01-07, 09:05 PM`."""
    return df.agg(F.date_format(F.max(loaded), "yyyy-MM-dd, hh:mm a").alias("last_updated"))


def choices(df: DataFrame, column: str | Column) -> DataFrame:
    """Sorted distinct values of a column, for a selection list."""
    column = F.col(column) if isinstance(column, str) else column
    return df.select(column.cast("string").alias("choice")).distinct().orderBy("choice")
