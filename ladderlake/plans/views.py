"""Analysis views over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderlake.functions.columns import elo_bucket, load_time, percentage_or_null, week_start
from ladderlake.operators.aggregates import lineups, matches_and_wins
from ladderlake.operators.joins import (
    broadcast_if_under,
    gathered_lineups,
    opposing_pairs,
    with_civ,
    with_match,
)
from ladderlake.sinks.files import export_csv_gz

# Sort order of each view, as exported.
CIV_PERFORMANCE_ORDER = ("civ", "map", "match_elo_bucket", "game_date")
OPPONENT_CIV_ORDER = ("civ", "opponent_civ", "map", "match_elo_bucket")
LEADERBOARD_ORDER = ("rank",)


def civ_performance(fact: DataFrame, matches: DataFrame, civs: DataFrame) -> DataFrame:
    """Matches, wins and win share of each civ by week, map and rating band.

    Matches are counted once however many players chose the civ; wins count players.
    Civ keys and names are one to one, so the names come in last, on the few result rows.
    """
    per_match = with_match(
        lineups(fact),
        matches,
        week_start("game_date").alias("game_date"),
        "map",
        elo_bucket("avg_elo").alias("match_elo_bucket"),
    )
    totals = matches_and_wins(per_match, "civ_fk", "game_date", "map", "match_elo_bucket")
    return with_civ(totals, civs).select(
        "civ", "game_date", "map", "match_elo_bucket", "matches_played", "wins", "win_percentage"
    )


def opponent_civ(fact: DataFrame, matches: DataFrame, civs: DataFrame) -> DataFrame:
    """Matches, wins and win share of each civ against each other civ of the match.

    Every other civ of the match is an opponent, whichever team it was on.
    """
    per_match = with_match(
        gathered_lineups(lineups(fact), "match_fk", "civ_fk"),
        matches,
        "map",
        elo_bucket("avg_elo").alias("match_elo_bucket"),
    )
    pairs = opposing_pairs(per_match, "map", "match_elo_bucket").withColumnsRenamed(
        {"civ": "civ_fk", "opponent_civ": "opponent_civ_fk"}
    )
    totals = matches_and_wins(pairs, "civ_fk", "opponent_civ_fk", "map", "match_elo_bucket")
    roster = broadcast_if_under(civs)
    mine = with_civ(totals, roster, checked=True)
    named = with_civ(mine, roster, "opponent_civ_fk", "opponent_civ", checked=True)
    return named.select(
        "civ", "opponent_civ", "map", "match_elo_bucket", "matches_played", "wins",
        "win_percentage",
    )


def leaderboard(people: DataFrame) -> DataFrame:
    """Current standing of every player; no share for a player without matches."""
    total = F.col("wins") + F.col("losses")
    return people.select(
        F.col("gaming_name").alias("player_name"),
        F.col("current_rank").alias("rank"),
        F.col("current_rating").alias("rating"),
        F.col("country_name").alias("country"),
        percentage_or_null("wins", total).alias("win_percentage"),
        total.alias("total_matches"),
        "wins",
        "losses",
        F.col("last_match_date").alias("last_played"),
    )


def export(
    view: DataFrame, path: str, order: tuple[str, ...], loaded_at: Column | None = None
) -> None:
    export_csv_gz(view.withColumn("ldts", load_time(loaded_at)), path, *order)
