"""Declared table layouts, as Spark DDL.

Fixed values: column names, order and types that tables and files must have.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# ---- raw files -------------------------------------------------------------
RAW_PLAYERS = """
    civ string, game_id bigint, match_rating_diff double, new_rating bigint,
    old_rating bigint, profile_id double, replay_summary_raw string, team bigint,
    winner boolean
"""
RAW_MATCHES = """
    avg_elo double, duration bigint, game_id bigint, game_speed string,
    game_type string, irl_duration bigint, leaderboard string, map string,
    mirror boolean, num_players bigint, patch bigint, raw_match_type double,
    replay_enhanced boolean, started_timestamp timestamp, starting_age string,
    team_0_elo double, team_1_elo double
"""
RAW_LEADERBOARD_PAGE = """
    statGroups array<struct<
        id: int, name: string, type: int,
        members: array<struct<
            profile_id: bigint, name: string, alias: string,
            personal_statgroup_id: int, xp: int, level: int,
            leaderboardregion_id: int, country: string>>>>,
    leaderboardStats array<struct<
        statgroup_id: int, leaderboard_id: int, wins: int, losses: int,
        streak: int, disputes: int, drops: int, rank: int, ranktotal: int,
        ranklevel: int, rating: int, regionrank: int, regionranktotal: int,
        lastmatchdate: bigint, highestrank: int, highestranklevel: int,
        highestrating: int>>
"""
RAW_MANIFEST = """
    db_dumps array<struct<
        start_date: date, end_date: date, num_matches: int, num_players: int,
        matches_url: string, players_url: string, match_checksum: string,
        player_checksum: string>>,
    total_matches int, total_players int
"""
RAW_COUNTRIES = "Country string, Country_code string"

# ---- conformed tables ------------------------------------------------------
CALENDAR = "date date, year int, month int, day int, day_of_week int, is_weekend boolean"
MATCHES = """
    avg_elo decimal(38,2), game_duration_secs int, game_id int, game_speed string,
    game_type string, actual_duration_secs int, leaderboard string, map string,
    mirror boolean, num_players int, patch string, raw_match_type string,
    replay_enhanced boolean, started_timestamp timestamp, game_date date,
    starting_age string, team_0_elo int, team_1_elo int, ldts timestamp,
    source string, file_date date
"""
PLAYERS = """
    id string, game_id int, team string, profile_id int, civ_name string,
    winner boolean, match_rating_diff int, new_rating int, old_rating int,
    source string, file_date date
"""
LEADERBOARDS = """
    disputes int, drops int, highestrank int, highestranklevel int,
    highestrating int, last_match_date timestamp, leaderboard_id int, losses int,
    rank int, ranklevel int, ranktotal int, rating int, regionrank int,
    regionranktotal int, statgroup_id int, streak int, wins int, ldts timestamp,
    source string
"""
STATGROUPS = """
    id int, group_name string, type int, alias string, country string,
    leaderboardregion_id int, level int, name string, personal_statgroup_id int,
    profile_id int, xp int, ldts timestamp, source string
"""

# ---- star schema -----------------------------------------------------------
DIM_CIV = """
    civ_pk string, civ_name string, civ_weaknesses string, civ_strengths string,
    load_date date
"""
DIM_DATE = """
    date_pk int, date date, year int, month int, day int, day_of_week int,
    is_weekend boolean, load_date date
"""
DIM_MATCH = """
    match_pk string, game_id int, map string, avg_elo decimal(38,2),
    game_duration_secs int, actual_duration_secs int, started_timestamp timestamp,
    game_date date, team_0_elo int, team_1_elo int, leaderboard string,
    mirror boolean, patch string, load_date date, source string, file_date date
"""
DIM_PLAYER = """
    player_pk string, profile_id int, gaming_name string, country_code string,
    country_name string, statgroup_id int, wins int, losses int, current_rank int,
    current_rating int, last_match_date timestamp, load_date date, source string
"""
FACT_PLAYER_MATCHES = """
    fact_pk string, player_fk string, match_fk string, civ_fk string, date_fk int,
    team string, winner boolean, match_rating_diff int, new_rating int,
    old_rating int, source string, file_date date, load_date date
"""

# ---- exported views --------------------------------------------------------
VIEW_CIV_PERFORMANCE = """
    civ string, game_date date, map string, match_elo_bucket string,
    matches_played bigint, wins bigint, win_percentage double, ldts timestamp
"""
VIEW_OPPONENT_CIV = """
    civ string, opponent_civ string, map string, match_elo_bucket string,
    matches_played bigint, wins bigint, win_percentage double, ldts timestamp
"""
VIEW_LEADERBOARD = """
    player_name string, rank int, rating int, country string,
    win_percentage double, total_matches int, wins int, losses int,
    last_played timestamp, ldts timestamp
"""


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(" ".join(ddl.split()))
