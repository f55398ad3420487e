"""Flattening of nested leaderboard documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_structs(df: DataFrame, array: str, *keep: str) -> DataFrame:
    """One row per struct of an array, its fields as columns. Null and empty arrays
    yield no row."""
    return df.select(F.inline(array), *keep)


def flatten_members(
    pages: DataFrame, *keep: str, groups: str = "statGroups", members: str = "members"
) -> DataFrame:
    """One row per group member, with the group's id, name and type."""
    grouped = pages.select(F.explode(groups).alias("g"), *keep)
    return grouped.select(
        F.col("g.id").alias("id"),
        F.col("g.name").alias("group_name"),
        F.col("g.type").alias("type"),
        F.inline(F.col("g")[members]),
        *keep,
    )
