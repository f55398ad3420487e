"""Silver: typed, flattened and de-duplicated tables, and their gated history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake import schemas
from ladderlake.functions.columns import composite_key, conform, date_key, nanos_to_secs
from ladderlake.operators.filters import in_run_window
from ladderlake.operators.joins import lookup_with_default
from ladderlake.operators.latest import latest_by_key
from ladderlake.operators.nested import explode_structs, flatten_members
from ladderlake.plans.publish import publish
from ladderlake.quality.rules import InRange, key_gate
from ladderlake.sinks.tables import write_table
from ladderlake.sources.scans import scan_table

# The ladder the analysis is about, the plausible range of match dates.
RANKED_LADDER = "random_map"
FIRST_GAME_DATE, LAST_GAME_DATE = "2021-01-01", "2026-01-01"


# ---- plans -----------------------------------------------------------------
def keyed_calendar(days: DataFrame) -> DataFrame:
    return days.withColumn("date_pk", date_key("date"))


def typed_matches(bronze: DataFrame) -> DataFrame:
    """Matches of the ranked ladder; durations in seconds, the start also as a date."""
    ranked = bronze.filter(F.col("leaderboard") == RANKED_LADDER).withColumns(
        {
            "game_duration_secs": nanos_to_secs("duration"),
            "actual_duration_secs": nanos_to_secs("irl_duration"),
            "game_date": F.to_date("started_timestamp"),
        }
    )
    return conform(ranked, schemas.MATCHES)


def typed_players(bronze: DataFrame) -> DataFrame:
    """Players with a known profile, keyed by match and profile."""
    known = bronze.filter(F.col("profile_id").isNotNull()).withColumns(
        {"id": composite_key("game_id", "profile_id"), "civ_name": F.initcap("civ")}
    )
    return conform(known, schemas.PLAYERS)


def current_leaderboards(bronze: DataFrame) -> DataFrame:
    """Latest leaderboard row of each group.

    Equal rows need no dedup of their own: of one key's rows one is kept anyway, and the
    shuffle that a dedup of whole rows would take is saved.
    """
    rows = explode_structs(bronze, "leaderboardStats", "ldts", "source").withColumn(
        "last_match_date", F.timestamp_seconds("lastmatchdate")
    )
    return conform(latest_by_key(rows, "statgroup_id", "ldts"), schemas.LEADERBOARDS)


def current_statgroups(bronze: DataFrame) -> DataFrame:
    """Latest membership row of each profile."""
    rows = flatten_members(bronze, "ldts", "source")
    return conform(latest_by_key(rows, "profile_id", "ldts"), schemas.STATGROUPS)


def player_standings(
    leaderboards: DataFrame, statgroups: DataFrame, countries: DataFrame
) -> DataFrame:
    """Each player's profile and country beside the standing of their group."""
    people = statgroups.select(
        "profile_id",
        F.col("alias").alias("gaming_name"),
        "personal_statgroup_id",
        F.col("country").alias("country_code"),
    )
    standings = leaderboards.select(
        "statgroup_id",
        "wins",
        "losses",
        F.col("rank").alias("current_rank"),
        F.col("rating").alias("current_rating"),
        "last_match_date",
        "ldts",
        "source",
    )
    joined = standings.join(
        people, F.col("statgroup_id") == F.col("personal_statgroup_id")
    )
    names = countries.select(
        F.col("Country").alias("_country_name"), F.col("Country_code").alias("_country_cd")
    )
    named = lookup_with_default(
        joined, names, F.col("country_code") == F.col("_country_cd"),
        value="_country_name", default="Unknown", alias="country_name",
    )
    return named.select(
        "profile_id",
        "gaming_name",
        "country_code",
        "country_name",
        "statgroup_id",
        "wins",
        "losses",
        "current_rank",
        "current_rating",
        "last_match_date",
        "ldts",
        "source",
    )


# ---- jobs ------------------------------------------------------------------
def load_calendar(spark: SparkSession, source: str, table: str) -> None:
    publish(spark, keyed_calendar(scan_table(spark, source)), table, "date_pk")


def load_matches(spark: SparkSession, source: str, table: str) -> None:
    write_table(typed_matches(scan_table(spark, source)), table, partition_by="file_date")


def load_players(spark: SparkSession, source: str, table: str) -> None:
    write_table(typed_players(scan_table(spark, source)), table, partition_by="file_date")


def load_leaderboards(spark: SparkSession, source: str, table: str) -> None:
    write_table(current_leaderboards(scan_table(spark, source)), table)


def load_statgroups(spark: SparkSession, source: str, table: str) -> None:
    write_table(current_statgroups(scan_table(spark, source)), table)


def merge_matches(
    spark: SparkSession,
    source: str,
    table: str,
    window: tuple[date | str, date | str],
    game_dates: tuple[str, str] = (FIRST_GAME_DATE, LAST_GAME_DATE),
) -> None:
    rows = scan_table(spark, source).filter(in_run_window("file_date", *window))
    gate = key_gate("game_id", InRange("game_date", *game_dates))
    publish(spark, rows, table, "game_id", gate, partition_by="file_date")


def merge_players(
    spark: SparkSession, source: str, table: str, window: tuple[date | str, date | str]
) -> None:
    rows = scan_table(spark, source).filter(in_run_window("file_date", *window))
    publish(spark, rows, table, "id", key_gate("id"), partition_by="file_date")


def load_standings(
    spark: SparkSession, leaderboards: str, statgroups: str, countries: str, table: str
) -> None:
    rows = player_standings(
        scan_table(spark, leaderboards),
        scan_table(spark, statgroups),
        scan_table(spark, countries),
    )
    write_table(rows, table)
