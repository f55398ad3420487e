"""Keep the newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(
    df: DataFrame, keys: str | Sequence[str], newest: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """The row of each key with the highest `newest`.

    Rows that tie on `newest` are ordered by `ties` (default: all other columns, highest
    first), so the choice never depends on how the data happens to be partitioned.
    Spark ranks within each map task first and shuffles one row per key and task, so a
    key that holds most of the table does not end up in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ties = [c for c in df.columns if c not in (*keys, newest)] if ties is None else ties
    order = [F.col(c).desc() for c in (newest, *ties)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
