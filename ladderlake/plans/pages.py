"""Dashboard pages: a selection over an exported view, re-aggregated and labelled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ladderlake.operators.aggregates import roll_up
from ladderlake.operators.filters import selected

# Labels shown on the pages.
LEADERBOARD_LABELS = {
    "player_name": "Player Name",
    "rank": "Rank",
    "rating": "Rating",
    "country": "Country",
    "win_percentage": "Win Percent",
    "total_matches": "Total Matches",
    "wins": "Wins",
    "losses": "Losses",
    "last_played": "Last Played",
}
CIV_COMPARE_LABELS = {
    "civ": "Civ",
    "opponent_civ": "Opponent Civ",
    "matches_played": "Matches Played",
    "wins": "Wins against Opponent Civ",
    "win_percentage": "Win Percentage against Opponent Civ",
}
CIV_TREND_LABELS = {
    "civ": "Civ",
    "game_date": "Match Date",
    "map": "Map",
    "match_elo_bucket": "Elo",
    "matches_played": "Matches Played",
    "wins": "Wins",
    "win_percentage": "Win %",
}

Choices = Mapping[str, Sequence]


def leaderboard_page(view: DataFrame, choices: Choices) -> DataFrame:
    """Chosen players and countries (all, where nothing is chosen)."""
    return selected(view, choices).withColumnsRenamed(LEADERBOARD_LABELS)


def civ_compare_page(view: DataFrame, choices: Choices) -> DataFrame:
    """Each civ against each opponent, over the chosen opponents, maps and bands."""
    totals = roll_up(selected(view, choices), "civ", "opponent_civ")
    return totals.withColumnsRenamed(CIV_COMPARE_LABELS)


def civ_trend_page(view: DataFrame, choices: Choices) -> DataFrame:
    """Weekly win share of the chosen civ, map and band."""
    totals = roll_up(selected(view, choices), "civ", "map", "match_elo_bucket", "game_date")
    return totals.withColumnsRenamed(CIV_TREND_LABELS)
