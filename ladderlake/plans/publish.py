"""How a table job ends: its result is written once, gated, and merged into its table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ladderlake.quality.rules import Rule, enforce
from ladderlake.sinks.tables import Merged, upsert


def publish(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    key: str,
    gate: Sequence[Rule] = (),
    partition_by: str | None = None,
    hashed: Sequence[str] = (),
) -> Merged:
    """Run the plan once, into files of the table's layout; the gate and the merge read those.

    A result that fails its gate never reaches the table. One that passes becomes part of the
    table where its files are: a first load, and any partition that is new, is written once.
    """
    check = partial(enforce, rules=gate) if gate else None
    return upsert(spark, df, table, key, partition_by, check=check, hashed=hashed)
