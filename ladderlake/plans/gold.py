"""Gold: the star schema. Every table is gated on its key and merged."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake import schemas
from ladderlake.functions.columns import composite_key, conform, load_date, single_key
from ladderlake.operators.filters import in_run_window
from ladderlake.operators.joins import BROADCAST_ROWS, broadcast_if_under, star_fact
from ladderlake.plans.publish import publish
from ladderlake.quality.rules import NotNull, key_gate
from ladderlake.sources.scans import scan_table

# ---- plans -----------------------------------------------------------------
def civ_dimension(players: DataFrame, loaded_on: Column | None = None) -> DataFrame:
    # Names are made distinct before they are hashed, so only the roster is.
    roster = players.select("civ_name").distinct().withColumns(
        {
            "civ_pk": single_key("civ_name"),
            "civ_weaknesses": F.lit(""),
            "civ_strengths": F.lit(""),
        }
    )
    return _loaded(roster, schemas.DIM_CIV, loaded_on)


def date_dimension(days: DataFrame, loaded_on: Column | None = None) -> DataFrame:
    return _loaded(days, schemas.DIM_DATE, loaded_on)


def match_dimension(
    matches: DataFrame,
    window: tuple[date | str, date | str],
    loaded_on: Column | None = None,
) -> DataFrame:
    in_window = matches.filter(in_run_window("file_date", *window))
    keyed = in_window.withColumn("match_pk", composite_key("game_id", "source"))
    return _loaded(keyed, schemas.DIM_MATCH, loaded_on)


def player_dimension(standings: DataFrame, loaded_on: Column | None = None) -> DataFrame:
    keyed = standings.withColumn("player_pk", composite_key("profile_id", "source"))
    return _loaded(keyed, schemas.DIM_PLAYER, loaded_on)


def player_match_fact(
    players: DataFrame,
    civs: DataFrame,
    matches: DataFrame,
    people: DataFrame,
    days: DataFrame,
    window: tuple[date | str, date | str],
    loaded_on: Column | None = None,
) -> DataFrame:
    in_window = players.filter(in_run_window("file_date", *window))
    fact = star_fact(in_window, civs, matches, people, days)
    return _loaded(fact, schemas.FACT_PLAYER_MATCHES, loaded_on)


def _loaded(df: DataFrame, layout: str, loaded_on: Column | None) -> DataFrame:
    return conform(df.withColumn("load_date", load_date(loaded_on)), layout)


# ---- jobs ------------------------------------------------------------------
def merge_civs(spark: SparkSession, players: str, table: str) -> None:
    publish(spark, civ_dimension(scan_table(spark, players)), table, "civ_pk", key_gate("civ_pk"))


def merge_dates(spark: SparkSession, days: str, table: str) -> None:
    publish(spark, date_dimension(scan_table(spark, days)), table, "date_pk", key_gate("date_pk"))


def merge_matches(
    spark: SparkSession, matches: str, table: str, window: tuple[date | str, date | str]
) -> None:
    rows = match_dimension(scan_table(spark, matches), window)
    gate = key_gate("match_pk", NotNull("game_id"))
    publish(spark, rows, table, "match_pk", gate, partition_by="file_date")


def merge_people(spark: SparkSession, standings: str, table: str) -> None:
    rows = player_dimension(scan_table(spark, standings))
    # The key hashes whatever parts it has, so its parts are gated too.
    gate = key_gate("player_pk", NotNull("profile_id"))
    publish(spark, rows, table, "player_pk", gate)


def merge_fact(
    spark: SparkSession,
    players: str,
    civs: str,
    matches: str,
    people: str,
    days: str,
    table: str,
    window: tuple[date | str, date | str],
) -> None:
    rows = player_match_fact(
        scan_table(spark, players),
        scan_table(spark, civs),
        scan_table(spark, matches),
        scan_table(spark, people),
        broadcast_if_under(scan_table(spark, days), BROADCAST_ROWS),
        window,
    )
    foreign = ("player_fk", "match_fk", "civ_fk")
    publish(spark, rows, table, "fact_pk", key_gate("fact_pk"), "file_date", foreign)
