from __future__ import annotations

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from ladderlake.operators.filters import RunWindow
from ladderlake.sources.calendar import calendar, weekly_paths, weekly_windows


def weeks_by_hand(first: date, last: date) -> list[date]:
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    return [d for d in days if d.weekday() == 6 and d + timedelta(days=6) <= last]


def windows(spark, *ranges):
    df = spark.createDataFrame(list(ranges), "first date, last date")
    return weekly_windows(df, "first", "last")


def test_two_whole_weeks(spark):
    out = windows(spark, (date(2023, 1, 1), date(2023, 1, 14))).orderBy("dated").collect()
    assert [r["query_str"] for r in out] == [
        "2023-01-01_2023-01-07", "2023-01-08_2023-01-14"
    ]


def test_weekly_paths(spark):
    df = spark.createDataFrame(
        [(date(2023, 1, 1), "2023-01-01_2023-01-07")], "dated date, query_str string"
    )
    assert weekly_paths(df, "stats").first().asDict() == {
        "file_date": "2023-01-01",
        "endpoint_str": "2023-01-01_2023-01-07/stats.parquet",
    }


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.dates(date(2019, 12, 1), date(2025, 1, 1)), st.integers(min_value=-10, max_value=60)
        ),
        min_size=1,
        max_size=40,
    )
)
def test_windows_match_brute_force(spark, spans):
    """Any range, also one that is too short or runs backwards."""
    ranges = sorted({(a, a + timedelta(days=n)) for a, n in spans})
    expected = sorted((a, b, w) for a, b in ranges for w in weeks_by_hand(a, b))
    assert rows(windows(spark, *ranges).select("first", "last", "dated")) == sorted(
        expected, key=repr
    )


def test_standard_calendar(spark):
    days = calendar(spark)
    assert days.count() == 3653
    picked = days.filter(F.col("date").isin(date(2024, 1, 6), date(2024, 1, 8)))
    assert rows(picked) == [
        (date(2024, 1, 6), 2024, 1, 6, 5, True), (date(2024, 1, 8), 2024, 1, 8, 0, False)
    ]


def test_run_window():
    today = date(2024, 1, 31)
    assert tuple(RunWindow.resolve(today=today)) == (date(2024, 1, 11), date(2024, 1, 26))
    assert RunWindow.resolve("2023-05-01", None, today).start == date(2023, 5, 1)
    assert RunWindow.resolve(None, "2023-05-09", today).end == date(2023, 5, 9)
