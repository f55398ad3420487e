"""Table jobs, views and pages, run as a pipeline runs them.

A job reads its inputs by table name; here they are named frames over the given tables.
What it writes goes to a database of its own in scratch space and is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake import schemas
from ladderlake.plans import bronze, gold, pages, silver, views
from ladderlake.registry import ORACLES, register
from ladderlake.registry import stand_ins as s
from ladderlake.registry.aggregate_queries import civ_view, opponent_view
from ladderlake.registry.join_queries import FACT_CTES, FACT_SQL, star_inputs
from ladderlake.registry.stand_ins import as_view, table, with_ctes
from ladderlake.sinks.files import land_json, land_parquet
from ladderlake.sinks.tables import write_table
from ladderlake.sinks.workspace import fresh_path
from ladderlake.sources import scans

# The load that the stand-in feeds come with last.
LOADED = "TIMESTAMP '2024-01-02' AS ldts"
IN_WINDOW = f"file_date BETWEEN DATE '{s.WINDOW[0]}' AND DATE '{s.WINDOW[1]}'"


# ---- bronze ----------------------------------------------------------------
def _bronze_dated(spark, raw, name):
    """Land dated files, then load the run window of them."""
    path = fresh_path(spark, name)
    land_parquet(raw, path)
    target = f"{s.scratch_database(spark, name)}.{name}_br"
    bronze.load_files(spark, scans.weekly_parquet(path, s.MATCH_SOURCE), target, s.WINDOW)
    # File names and load times are of the run; everything else is data.
    return spark.table(target).drop("fn", "ldts")


@register(
    "job_bronze_matches",
    with_ctes(
        f"SELECT *, '{s.MATCH_SOURCE}' AS source FROM raw_matches WHERE {IN_WINDOW}", "raw_matches"
    ),
)
def job_bronze_matches(spark, sf):
    loaded = _bronze_dated(spark, s.raw_matches(spark, sf), "matches")
    return loaded.withColumn("started_timestamp", F.col("started_timestamp").cast("timestamp_ntz"))


@register(
    "job_bronze_players",
    with_ctes(
        f"""SELECT DISTINCT * REPLACE (coalesce(profile_id, -1) AS profile_id),
 '{s.MATCH_SOURCE}' AS source FROM raw_players WHERE {IN_WINDOW}""",
        "raw_players",
    ),
)
def job_bronze_players(spark, sf):
    loaded = _bronze_dated(spark, s.raw_players(spark, sf), "players")
    return loaded.withColumn("profile_id", F.coalesce("profile_id", F.lit(-1)))


@register(
    "job_bronze_relic",
    with_ctes(
        s.PAGE_ENTRIES.format(base=s.GROUP_BASE, more=f"'{s.BOARD_SOURCE}' AS source"),
        "supplier_stats", "leaderboards_sr",
    ),
)
def job_bronze_relic(spark, sf):
    """Landed leaderboard pages, a document per line."""
    path = fresh_path(spark, "pages")
    land_json(s.leaderboard_pages(spark, sf).select("statGroups", "leaderboardStats"), path)
    target = f"{s.scratch_database(spark, 'pages')}.leaderboard_pages_br"
    feed = scans.json_lines(path, s.BOARD_SOURCE, schemas.RAW_LEADERBOARD_PAGE)
    bronze.load_files(spark, feed, target)
    return s.page_entries(spark.table(target), "source")


@register(
    "job_bronze_country",
    with_ctes("SELECT Country, Country_code, 'LOOKUP' AS source FROM countries", "countries"),
)
def job_bronze_country(spark, sf):
    path = fresh_path(spark, "countries")
    s.countries(spark, sf).write.option("header", True).csv(path)
    target = f"{s.scratch_database(spark, 'countries')}.country_list_br"
    bronze.load_files(spark, scans.csv_lookup(path, "LOOKUP", schemas.RAW_COUNTRIES), target)
    return spark.table(target).drop("fn", "ldts")


@register("job_bronze_dim_date", with_ctes("SELECT * FROM days", "days"))
def job_bronze_dim_date(spark, sf):
    """Calendar of the years the orders span."""
    first, last = table(spark, sf, "orders").agg(
        F.date_format(F.min("o_orderdate"), "yyyy-01-01"),
        F.date_format(F.max("o_orderdate"), "yyyy-12-31"),
    ).first()
    target = f"{s.scratch_database(spark, 'calendar')}.dim_date_br"
    bronze.load_calendar(spark, target, first, last)
    return spark.table(target)


# ---- silver ----------------------------------------------------------------
def _target(spark, name):
    return f"{s.scratch_database(spark, name)}.{name}"


@register("job_silver_dim_date", with_ctes("SELECT * FROM keyed_days", "days", "keyed_days"))
def job_silver_dim_date(spark, sf):
    target = _target(spark, "dim_date_sr")
    silver.load_calendar(spark, as_view(s.days(spark, sf), "dim_date_br"), target)
    return spark.table(target)


def _ntz(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _matches(df):
    """Matches with types both engines print alike."""
    times = [c for c in ("started_timestamp", "ldts") if c in df.columns]
    return _ntz(df, *times).withColumn("avg_elo", F.col("avg_elo").cast("double"))


_MATCHES_SQL = "SELECT * REPLACE (CAST(avg_elo AS DOUBLE) AS avg_elo) FROM matches_sr"


@register(
    "job_silver_leaderboards",
    with_ctes(f"SELECT *, {LOADED} FROM leaderboards_sr", "supplier_stats", "leaderboards_sr"),
)
def job_silver_leaderboards(spark, sf):
    target = _target(spark, "leaderboards_sr")
    silver.load_leaderboards(spark, as_view(s.bronze_pages(spark, sf), "pages_br"), target)
    return _ntz(spark.table(target), "last_match_date", "ldts")


@register(
    "job_silver_statgroup",
    with_ctes(f"SELECT *, {LOADED} FROM statgroup_sr", "supplier_stats", "statgroup_sr"),
)
def job_silver_statgroup(spark, sf):
    target = _target(spark, "statgroup_sr")
    silver.load_statgroups(spark, as_view(s.bronze_pages(spark, sf), "pages_br"), target)
    return _ntz(spark.table(target), "ldts")


@register(
    "job_silver_matches", with_ctes(f"SELECT *, {LOADED} FROM ({_MATCHES_SQL})", *s.MATCHES)
)
def job_silver_matches(spark, sf):
    target = _target(spark, "matches_sr")
    silver.load_matches(spark, as_view(s.bronze_matches(spark, sf), "matches_br"), target)
    return _matches(spark.table(target))


@register("job_silver_players", with_ctes("SELECT * FROM players_sr", *s.PLAYERS))
def job_silver_players(spark, sf):
    target = _target(spark, "players_sr")
    silver.load_players(spark, as_view(s.bronze_players(spark, sf), "players_br"), target)
    return spark.table(target)


@register(
    "job_silver2_matches",
    with_ctes(f"SELECT *, {LOADED} FROM ({_MATCHES_SQL}) WHERE {IN_WINDOW}", *s.MATCHES),
)
def job_silver2_matches(spark, sf):
    """A first load of a part of the window, then one of the whole: inserts and updates."""
    target = _target(spark, "matches_s2r")
    typed = as_view(silver.typed_matches(s.bronze_matches(spark, sf)), "matches_sr")
    first = (s.WINDOW[0], "1998-12-31")
    for window in (first, s.WINDOW):
        silver.merge_matches(spark, typed, target, window, s.GAME_DATES)
    return _matches(spark.table(target))


@register(
    "job_silver2_players",
    with_ctes(f"SELECT * FROM players_one WHERE {IN_WINDOW}", *s.PLAYERS, "players_one"),
)
def job_silver2_players(spark, sf):
    target = _target(spark, "players_s2r")
    typed = as_view(s.unique_players(spark, sf), "players_sr")
    silver.merge_players(spark, typed, target, s.WINDOW)
    return spark.table(target)


@register(
    "job_silver2_player_leaderboard", with_ctes("SELECT * FROM standings", *s.STANDINGS)
)
def job_silver2_player_leaderboard(spark, sf):
    target = _target(spark, "standings_s2r")
    pages_br = s.bronze_pages(spark, sf)
    silver.load_standings(
        spark,
        as_view(silver.current_leaderboards(pages_br), "leaderboards_sr"),
        as_view(silver.current_statgroups(pages_br), "statgroup_sr"),
        as_view(s.countries(spark, sf), "country_list_br"),
        target,
    )
    return _ntz(spark.table(target).drop("ldts"), "last_match_date")


# ---- gold ------------------------------------------------------------------
@register(
    "job_dim_civ",
    with_ctes(
        """SELECT DISTINCT md5(civ_name) AS civ_pk, civ_name, '' AS civ_weaknesses,
 '' AS civ_strengths FROM players_sr""",
        *s.PLAYERS,
    ),
)
def job_dim_civ(spark, sf):
    target = _target(spark, "dim_civ_gd")
    typed = as_view(silver.typed_players(s.bronze_players(spark, sf)), "players_s2r")
    gold.merge_civs(spark, typed, target)
    return spark.table(target).drop("load_date")


@register("job_dim_date", with_ctes("SELECT * FROM keyed_days", "days", "keyed_days"))
def job_dim_date(spark, sf):
    target = _target(spark, "dim_date_gd")
    gold.merge_dates(spark, as_view(s.keyed_days(spark, sf), "dim_date_sr"), target)
    return spark.table(target).drop("load_date")


@register(
    "job_dim_match",
    with_ctes(
        f"""SELECT md5(concat_ws('~', CAST(game_id AS VARCHAR), source)) AS match_pk, game_id, map,
 CAST(avg_elo AS DOUBLE) AS avg_elo, game_duration_secs, actual_duration_secs, started_timestamp, game_date, team_0_elo,
 team_1_elo, leaderboard, mirror, patch, source, file_date
FROM matches_sr WHERE {IN_WINDOW}""",
        *s.MATCHES,
    ),
)
def job_dim_match(spark, sf):
    target = _target(spark, "dim_match_gd")
    typed = as_view(silver.typed_matches(s.bronze_matches(spark, sf)), "matches_s2r")
    gold.merge_matches(spark, typed, target, s.WINDOW)
    return _matches(spark.table(target).drop("load_date"))


@register(
    "job_dim_player",
    with_ctes(
        """SELECT md5(concat_ws('~', CAST(profile_id AS VARCHAR), source)) AS player_pk, *
FROM standings""",
        *s.STANDINGS,
    ),
)
def job_dim_player(spark, sf):
    target = _target(spark, "dim_player_gd")
    gold.merge_people(spark, as_view(s.standings(spark, sf), "standings_s2r"), target)
    return _ntz(spark.table(target).drop("load_date"), "last_match_date")


@register(
    "job_fact_player_matches", with_ctes(f"{FACT_SQL}\nWHERE p.{IN_WINDOW}", *FACT_CTES)
)
def job_fact_player_matches(spark, sf):
    """The dimensions are stored tables, as they are when the fact is loaded."""
    database = s.scratch_database(spark, "fact")
    players, civs, matches, people, days = star_inputs(spark, sf)
    for name, df in (("civ", civs), ("match", matches), ("player", people), ("date", days)):
        write_table(df, f"{database}.dim_{name}_gd")
    target = f"{database}.fact_player_matches_gd"
    gold.merge_fact(
        spark,
        as_view(players, "players_s2r"),
        *[f"{database}.dim_{d}_gd" for d in ("civ", "match", "player", "date")],
        target,
        s.WINDOW,
    )
    return spark.table(target).drop("load_date")


# ---- second loads ----------------------------------------------------------
# A part of the run window is loaded, then the whole of it: rows are inserted and replaced.
FIRST_PART = (s.WINDOW[0], "1998-12-31")


@register("job_silver2_players_again", ORACLES["job_silver2_players"])
def job_silver2_players_again(spark, sf):
    """The first load has other ratings, which the second one replaces."""
    target = _target(spark, "players_s2r")
    typed = s.unique_players(spark, sf)
    other = typed.withColumn("new_rating", F.col("new_rating") + 1)
    silver.merge_players(spark, as_view(other, "players_sr"), target, FIRST_PART)
    silver.merge_players(spark, as_view(typed, "players_sr"), target, s.WINDOW)
    return spark.table(target)


@register("job_dim_match_again", ORACLES["job_dim_match"])
def job_dim_match_again(spark, sf):
    """In the first load all matches are a quarter early: the second one moves them."""
    target = _target(spark, "dim_match_gd")
    typed = silver.typed_matches(s.bronze_matches(spark, sf))
    early = typed.withColumn("file_date", F.add_months("file_date", -3))
    gold.merge_matches(spark, as_view(early, "matches_s2r"), target, FIRST_PART)
    gold.merge_matches(spark, as_view(typed, "matches_s2r"), target, s.WINDOW)
    in_window = F.col("file_date").between(*s.WINDOW)
    # Those that the window cuts off were loaded early and never again.
    return _matches(spark.table(target).where(in_window).drop("load_date"))


@register("job_dim_player_again", ORACLES["job_dim_player"])
def job_dim_player_again(spark, sf):
    """A table without partitions: half of the standings, with other ranks, then all."""
    target = _target(spark, "dim_player_gd")
    now = s.standings(spark, sf)
    before = now.where("profile_id % 2 = 0").withColumn("current_rank", F.lit(0))
    gold.merge_people(spark, as_view(before, "standings_s2r"), target)
    gold.merge_people(spark, as_view(now, "standings_s2r"), target)
    return _ntz(spark.table(target).drop("load_date"), "last_match_date")


@register("job_fact_player_matches_again", ORACLES["job_fact_player_matches"])
def job_fact_player_matches_again(spark, sf):
    """The weekly case: the second load replaces what the first one brought and adds dates."""
    database = s.scratch_database(spark, "fact")
    players, civs, matches, people, days = star_inputs(spark, sf)
    for name, df in (("civ", civs), ("match", matches), ("player", people), ("date", days)):
        write_table(df, f"{database}.dim_{name}_gd")
    target = f"{database}.fact_player_matches_gd"
    dims = [f"{database}.dim_{d}_gd" for d in ("civ", "match", "player", "date")]
    lost = players.withColumn("winner", F.lit(False))
    for rows, window in ((lost, FIRST_PART), (players, s.WINDOW)):
        gold.merge_fact(spark, as_view(rows, "players_s2r"), *dims, target, window)
    return spark.table(target).drop("load_date")


# ---- views -----------------------------------------------------------------
@register("view_civ_performance", with_ctes("SELECT * FROM civ_view", *s.CIV_VIEW))
def view_civ_performance(spark, sf):
    return civ_view(spark, sf)


@register("view_opponent_civ", with_ctes("SELECT * FROM opponent_view", *s.OPPONENT_VIEW))
def view_opponent_civ(spark, sf):
    return opponent_view(spark, sf)


@register("view_leaderboard", with_ctes("SELECT * FROM leaderboard_view", *s.LEADERBOARD_VIEW))
def view_leaderboard(spark, sf):
    return _ntz(views.leaderboard(s.standings(spark, sf)), "last_played")


# ---- pages -----------------------------------------------------------------
@register(
    "page_leaderboard",
    with_ctes(
        """SELECT player_name AS "Player Name", rank AS "Rank", rating AS "Rating",
 country AS "Country", win_percentage AS "Win Percent", total_matches AS "Total Matches",
 wins AS "Wins", losses AS "Losses", last_played AS "Last Played"
FROM leaderboard_view WHERE country IN ('NATION_3', 'NATION_7', 'Unknown')""",
        *s.LEADERBOARD_VIEW,
    ),
)
def page_leaderboard(spark, sf):
    chosen = {"player_name": [], "country": ["NATION_3", "NATION_7", "Unknown"]}
    return pages.leaderboard_page(view_leaderboard(spark, sf), chosen)


@register(
    "page_civ_compare",
    with_ctes(
        """SELECT civ AS "Civ", opponent_civ AS "Opponent Civ",
 CAST(sum(matches_played) AS BIGINT) AS "Matches Played",
 CAST(sum(wins) AS BIGINT) AS "Wins against Opponent Civ",
 round(sum(wins) / sum(matches_played) * 100, 2) AS "Win Percentage against Opponent Civ"
FROM opponent_view WHERE map IN ('1-URGENT', '2-HIGH')
 AND match_elo_bucket IN ('800-1000', '1000-1200', '1801 or more')
GROUP BY civ, opponent_civ""",
        *s.OPPONENT_VIEW,
    ),
)
def page_civ_compare(spark, sf):
    chosen = {
        "opponent_civ": [],
        "map": ["1-URGENT", "2-HIGH"],
        "match_elo_bucket": ["800-1000", "1000-1200", "1801 or more"],
    }
    return pages.civ_compare_page(opponent_view(spark, sf), chosen)


@register(
    "page_civ_trend",
    with_ctes(
        """SELECT civ AS "Civ", game_date AS "Match Date", map AS "Map",
 match_elo_bucket AS "Elo", CAST(sum(matches_played) AS BIGINT) AS "Matches Played",
 CAST(sum(wins) AS BIGINT) AS "Wins",
 round(sum(wins) / sum(matches_played) * 100, 2) AS "Win %"
FROM civ_view WHERE civ = 'Brand#2' AND map = '2-HIGH' AND match_elo_bucket = '600 or less'
GROUP BY civ, game_date, map, match_elo_bucket""",
        *s.CIV_VIEW,
    ),
)
def page_civ_trend(spark, sf):
    chosen = {"civ": ["Brand#2"], "map": ["2-HIGH"], "match_elo_bucket": ["600 or less"]}
    return pages.civ_trend_page(civ_view(spark, sf), chosen)
