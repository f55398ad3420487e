"""Data-quality rules: one aggregate answers all rules of a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderlake.operators.filters import outside


@dataclass(frozen=True)
class NotNull:
    column: str
    name = "not_null"

    @property
    def target(self) -> str:
        return self.column

    def violations(self, df: DataFrame) -> Column:
        return F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class Unique:
    """Rows beyond the distinct values of the columns; null counts as a value."""

    columns: tuple[str, ...]
    name = "unique"

    @property
    def target(self) -> str:
        return ",".join(self.columns)

    def violations(self, df: DataFrame) -> Column:
        return F.count(F.lit(1)) - F.count_distinct(F.struct(*self.columns))

    def screened(self, df: DataFrame) -> Column:
        """At least as many, from hashes alone: none here are none at all. A shuffle of hashes
        is a fraction of one of keys."""
        return F.count(F.lit(1)) - F.count_distinct(F.xxhash64(*self.columns))


@dataclass(frozen=True)
class InRange:
    """Values outside [low, high]; null passes. Bounds take the column's type."""

    column: str
    low: object
    high: object
    name = "in_range"

    @property
    def target(self) -> str:
        return self.column

    def violations(self, df: DataFrame) -> Column:
        kind = df.schema[self.column].dataType
        return F.count_if(
            outside(self.column, F.lit(self.low).cast(kind), F.lit(self.high).cast(kind))
        )


@dataclass(frozen=True)
class HasColumns:
    """The columns are these, in this order. Costs no scan."""

    columns: tuple[str, ...]
    name = "has_columns"

    @property
    def target(self) -> str:
        return ",".join(self.columns)

    def violations(self, df: DataFrame) -> Column:
        return F.lit(int(tuple(df.columns) != self.columns))


@dataclass(frozen=True)
class NonEmpty:
    name = "non_empty"
    target = "*"

    def violations(self, df: DataFrame) -> Column:
        return F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)


Rule = NotNull | Unique | InRange | HasColumns | NonEmpty


class QualityError(ValueError):
    """A table broke at least one rule; `failures` are its report rows."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__(
            "; ".join(f"{f['rule']}({f['target']}): {f['violations']}" for f in failures)
        )


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`rule`, `target`, `violations`, `passed`, from one pass over the rules' columns."""
    return _report(df, rules, [rule.violations(df) for rule in rules])


def _report(df: DataFrame, rules: Sequence[Rule], violations: Sequence[Column]) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[found.cast("bigint").alias(f"_{i}") for i, found in enumerate(violations)],
    )
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.target).alias("target"),
            F.col(f"_{i}").alias("violations"),
            (F.col(f"_{i}") == 0).alias("passed"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def enforce(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise unless every rule holds. Only the report reaches the driver.

    Keys are counted by hash first; the exact report is made where that finds a fault.
    """
    quick = [r.screened(df) if isinstance(r, Unique) else r.violations(df) for r in rules]
    if _report(df, rules, quick).filter(~F.col("passed")).isEmpty():
        return
    failures = quality_report(df, rules).filter(~F.col("passed")).collect()
    if failures:
        raise QualityError(failures)


def key_gate(key: str, *extra: Rule) -> list[Rule]:
    """The gate of a keyed table: key known and unique, table not empty."""
    return [NotNull(key), Unique((key,)), *extra, NonEmpty()]
