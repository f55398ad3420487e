"""Predicates and filters. They stay plain column predicates, so they push down."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How far back the default run window reaches, in days.
BACKDATE_START, BACKDATE_END = 20, 5


@dataclass(frozen=True)
class RunWindow:
    """Inclusive range of file dates a run looks at."""

    start: date
    end: date

    @classmethod
    def resolve(
        cls,
        start: str | None = None,
        end: str | None = None,
        today: date | None = None,
        back_start: int = BACKDATE_START,
        back_end: int = BACKDATE_END,
    ) -> RunWindow:
        """Explicit dates win; a missing one is counted back from today."""
        today = today or date.today()
        return cls(
            date.fromisoformat(start) if start else today - timedelta(days=back_start),
            date.fromisoformat(end) if end else today - timedelta(days=back_end),
        )

    def __iter__(self):
        return iter((self.start, self.end))


def resolved_date(explicit: Column, today: Column, days_back: int) -> Column:
    """Column form of the same rule, for windows that are themselves data."""
    return F.coalesce(F.to_date(explicit, "yyyy-MM-dd"), F.date_sub(today, days_back))


def in_run_window(day: str, start: date | str, end: date | str) -> Column:
    return F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def outside(column: str, low, high) -> Column:
    """Below `low` or above `high`; unknown values are not outside."""
    c = F.col(column)
    return (c < low) | (c > high)


def selected(df: DataFrame, choices: Mapping[str, Sequence]) -> DataFrame:
    """Keep rows matching every non-empty choice list; an empty list keeps all."""
    tests = [F.col(name).isin(list(values)) for name, values in choices.items() if values]
    return df.filter(reduce(and_, tests)) if tests else df
