"""Tolerant per-value conversions used before a record is judged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def float_id(value: Column) -> Column:
    """Identifier that arrived as a float or as text: "123.0" -> 123, NaN/blank -> null."""
    number = value.try_cast("double")
    return F.when(F.isnan(number), None).otherwise(number).try_cast("bigint")


def to_text(value: Column) -> Column:
    return value.cast("string")


def to_float(value: Column) -> Column:
    return value.try_cast("double")


def cast_failures(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """One row per requested cast: `field`, `target_type`, `present`, `failures`.

    All casts are counted in a single pass over the data.
    """
    present = {name: kind for name, kind in casts.items() if name in df.columns}
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()).alias(name)
            for name, kind in present.items()
        ],
    )
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit(kind).alias("target_type"),
            F.lit(name in present).alias("present"),
            (F.col(name) if name in present else F.lit(None).cast("bigint")).alias("failures"),
        )
        for name, kind in casts.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def recast(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Apply each cast that every value of its column survives; leave the others be.

    The decision needs one aggregate over the cast columns, of one row per cast.
    """
    if not casts:
        return df
    verdict = cast_failures(df, casts).collect()
    safe = {r["field"]: r["target_type"] for r in verdict if r["present"] and r["failures"] == 0}
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in safe.items()})
