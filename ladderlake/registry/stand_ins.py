"""The given tables in the shape of match statistics, once for Spark and once for SQL.

An order is a match, a line item a player in it, a part brand a civ, a supplier a player
profile, a nation a country. Every frame covers its whole tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderlake.functions.columns import composite_key, single_key
from ladderlake.sinks.workspace import fresh_path

MATCH_SOURCE, BOARD_SOURCE = "MATCH_FEED", "LEADERBOARD_FEED"
WINDOW = ("1995-04-01", "2001-06-30")
GAME_DATES = ("1995-01-01", "2001-12-31")
PAGE_ROWS = 25
FILE_PAGES = 32
# Suppliers are profiles 0, 1, ...; their groups are numbered from here.
GROUP_BASE = 1000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def with_ctes(body: str, *names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


def scratch_database(spark: SparkSession, name: str) -> str:
    """A database of its own for a query that writes tables."""
    database = f"ladderlake_{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_path(spark, database)}'")
    return database


def as_view(df: DataFrame, name: str) -> str:
    """Name a frame, so that a job can read it as its input table."""
    view = f"{name}_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    return view


def quarter_of(day: str) -> Column:
    """File date of a row: the feed has a file per quarter."""
    return F.to_date(F.trunc(day, "quarter"))


def _whole(c: Column, kind: str = "bigint") -> Column:
    return c.cast(kind)


# ---- matches ---------------------------------------------------------------
def raw_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Match files: every order."""
    nanos = 1_000_000_000
    return table(spark, sf, "orders").select(
        (F.floor("o_totalprice") / 256).alias("avg_elo"),
        ((F.col("o_custkey") % 3600 + 600) * nanos + 750_000_000).alias("duration"),
        F.col("o_orderkey").alias("game_id"),
        F.lower("o_orderpriority").alias("game_speed"),
        F.col("o_orderstatus").alias("game_type"),
        ((F.col("o_custkey") % 1800 + 300) * nanos + 250_000_000).alias("irl_duration"),
        F.when(F.col("o_orderstatus") == "P", "team_random_map")
        .otherwise("random_map")
        .alias("leaderboard"),
        F.col("o_orderpriority").alias("map"),
        (F.col("o_custkey") % 2 == 0).alias("mirror"),
        (F.col("o_orderkey") % 7 + 2).alias("num_players"),
        (F.col("o_custkey") % 10 + 100000).alias("patch"),
        F.when(F.col("o_custkey") % 5 != 0, (F.col("o_custkey") % 10).cast("double")).alias(
            "raw_match_type"
        ),
        (F.col("o_orderkey") % 2 == 0).alias("replay_enhanced"),
        F.col("o_orderdate").cast("timestamp").alias("started_timestamp"),
        F.col("o_orderstatus").alias("starting_age"),
        (F.floor("o_totalprice") / 256).alias("team_0_elo"),
        (F.floor("o_totalprice") / 512).alias("team_1_elo"),
        quarter_of("o_orderdate").alias("file_date"),
    )


def bronze_matches(spark: SparkSession, sf: str) -> DataFrame:
    return raw_matches(spark, sf).withColumns(
        {"source": F.lit(MATCH_SOURCE), "ldts": F.lit("2024-01-02").cast("timestamp")}
    )


# ---- players ---------------------------------------------------------------
def raw_players(spark: SparkSession, sf: str) -> DataFrame:
    """Player files: every line item; the seventh line of an order is an
    unknown profile."""
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem")
    return lines.join(brands, lines.l_partkey == brands.p_partkey).select(
        F.lower("p_brand").alias("civ"),
        F.col("l_orderkey").alias("game_id"),
        (F.col("l_quantity") - 25).alias("match_rating_diff"),
        _whole(F.floor(F.col("l_extendedprice") / 64)).alias("new_rating"),
        _whole(F.floor(F.col("l_extendedprice") / 64) - F.floor("l_quantity")).alias("old_rating"),
        F.when(F.col("l_linenumber") != 7, F.col("l_suppkey")).alias("profile_id"),
        F.col("l_linestatus").alias("replay_summary_raw"),
        _whole(F.col("l_linenumber") % 2).alias("team"),
        (F.col("l_returnflag") == "R").alias("winner"),
        quarter_of("l_shipdate").alias("file_date"),
    )


def bronze_players(spark: SparkSession, sf: str) -> DataFrame:
    return raw_players(spark, sf).withColumn("source", F.lit(MATCH_SOURCE))


def unique_players(spark: SparkSession, sf: str) -> DataFrame:
    """Typed players, one row per match and profile, as the gated history needs.

    The id is a hash of the two, so it is made behind the shuffle, as the source is. The
    latest row of each is the first of its run in its match: dealt by match, the rows need no
    other shuffle for a join on it.
    """
    from ladderlake.plans.silver import typed_players

    typed = typed_players(bronze_players(spark, sf))
    ties = [c for c in typed.columns if c not in ("id", "source", "game_id", "profile_id", "file_date")]
    order = ["profile_id", *[F.col(c).desc() for c in ("file_date", *ties)]]
    before = F.lag("profile_id").over(Window.partitionBy("game_id").orderBy(*order))
    first = typed.drop("id", "source").withColumn("_before", before)
    made = {"id": composite_key("game_id", "profile_id"), "source": F.lit(MATCH_SOURCE)}
    latest = first.where(~F.col("_before").eqNullSafe(F.col("profile_id"))).withColumns(made)
    return latest.select(*typed.columns)


# ---- leaderboards ----------------------------------------------------------
def supplier_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier with the results of its line items."""
    lines = table(spark, sf, "lineitem")
    results = lines.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").cast("int").alias("wins"),
        F.count_if(F.col("l_returnflag") == "A").cast("int").alias("losses"),
        F.max("l_shipdate").cast("timestamp").alias("last_played"),
    )
    suppliers = table(spark, sf, "supplier")
    return suppliers.join(results, suppliers.s_suppkey == results.l_suppkey)


def leaderboard_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of every supplier's standing: the older one ranks them one lower."""
    loads = F.array(
        *[
            F.struct(F.lit(ldts).cast("timestamp").alias("ldts"), F.lit(shift).alias("shift"))
            for ldts, shift in (("2024-01-01", 2), ("2024-01-02", 1))
        ]
    )
    stats = supplier_stats(spark, sf).select("*", F.inline(loads))
    key = F.col("s_suppkey").cast("int")
    stat = F.struct(
        (key + GROUP_BASE).alias("statgroup_id"),
        F.lit(3).alias("leaderboard_id"),
        "wins",
        "losses",
        (F.col("wins") - F.col("losses")).alias("streak"),
        F.lit(0).alias("disputes"),
        F.lit(0).alias("drops"),
        (key + F.col("shift")).alias("rank"),
        F.lit(100).alias("ranktotal"),
        F.lit(1).alias("ranklevel"),
        F.col("s_acctbal").cast("int").alias("rating"),
        F.col("s_nationkey").alias("regionrank"),
        F.lit(50).alias("regionranktotal"),
        F.unix_timestamp("last_played").alias("lastmatchdate"),
        (key + 1).alias("highestrank"),
        F.lit(1).alias("highestranklevel"),
        F.col("s_acctbal").cast("int").alias("highestrating"),
    )
    member = F.struct(
        F.col("s_suppkey").alias("profile_id"),
        F.concat(F.lit("/steam/"), F.col("s_suppkey").cast("string")).alias("name"),
        F.col("s_name").alias("alias"),
        (key + GROUP_BASE).alias("personal_statgroup_id"),
        F.lit(0).alias("xp"),
        F.lit(1).alias("level"),
        F.col("s_nationkey").alias("leaderboardregion_id"),
        F.concat(
            F.when(F.col("s_nationkey") < 20, "n").otherwise("x"), F.col("s_nationkey").cast("string")
        ).alias("country"),
    )
    group = F.struct(
        (key + GROUP_BASE).alias("id"),
        F.lit("").alias("name"),
        F.lit(1).alias("type"),
        F.array(member).alias("members"),
    )
    page = F.floor(F.col("s_suppkey") / PAGE_ROWS).alias("page")
    return stats.select(page, "ldts", group.alias("g"), stat.alias("s"))


def leaderboard_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows as nested pages. Supplier keys are unique, so a page and load has at
    most PAGE_ROWS entries, as a page of the real interface does."""
    return (
        leaderboard_rows(spark, sf)
        .groupBy("page", "ldts")
        .agg(F.collect_list("g").alias("statGroups"), F.collect_list("s").alias("leaderboardStats"))
    )


def write_page_files(spark: SparkSession, sf: str, path: str) -> None:
    """Pages as an interface delivers them: pretty-printed arrays of FILE_PAGES pages, a file
    each."""
    page = F.struct("statGroups", "leaderboardStats")
    (
        leaderboard_pages(spark, sf)
        .groupBy(F.floor(F.col("page") / FILE_PAGES).alias("batch"))
        .agg(F.to_json(F.collect_list(page), {"pretty": "true"}).alias("value"))
        .write.partitionBy("batch")
        .text(path)
    )


def page_entries(pages: DataFrame, *keep: str) -> DataFrame:
    """A row per leaderboard entry, with the one member of its group."""
    entries = pages.select("statGroups", *keep, F.explode("leaderboardStats").alias("stat"))
    group = F.filter("statGroups", lambda g: g["id"] == F.col("stat.statgroup_id"))[0]
    member = group["members"][0]
    return entries.select(
        *[f"stat.{c}" for c in ("statgroup_id", "wins", "losses", "rank", "rating")],
        F.timestamp_seconds("stat.lastmatchdate").cast("timestamp_ntz").alias("last_played"),
        member["profile_id"].alias("profile_id"),
        member["alias"].alias("alias"),
        member["country"].alias("country"),
        *keep,
    )


# The same entries in SQL: two loads of every standing.
PAGE_ENTRIES = """SELECT statgroup_id, wins, losses, rank + shift AS rank, rating,
 last_match_date AS last_played, s_suppkey AS profile_id, s_name AS alias,
 CASE WHEN s_nationkey < 20 THEN 'n' ELSE 'x' END || s_nationkey AS country, {more}
FROM leaderboards_sr JOIN supplier ON s_suppkey = statgroup_id - {base},
 (VALUES (0), (1)) AS t(shift)"""


def bronze_pages(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboard_pages(spark, sf).withColumn("source", F.lit(BOARD_SOURCE))


def countries(spark: SparkSession, sf: str) -> DataFrame:
    """Country lookup: every nation. The codes of some suppliers are not in it."""
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("Country"),
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("Country_code"),
    )


def standings(spark: SparkSession, sf: str) -> DataFrame:
    from ladderlake.plans import silver

    pages = bronze_pages(spark, sf)
    return silver.player_standings(
        silver.current_leaderboards(pages),
        silver.current_statgroups(pages),
        countries(spark, sf),
    )


# ---- star schema -----------------------------------------------------------
def fact(spark: SparkSession, sf: str) -> DataFrame:
    """Player rows of the star: every line item; no result is known for flag N."""
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem")
    return lines.join(brands, lines.l_partkey == brands.p_partkey).select(
        composite_key("l_orderkey", F.lit(MATCH_SOURCE)).alias("match_fk"),
        single_key("p_brand").alias("civ_fk"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R").alias("winner"),
    )


def match_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a match; some have no rating."""
    return table(spark, sf, "orders").select(
        composite_key("o_orderkey", F.lit(MATCH_SOURCE)).alias("match_pk"),
        F.col("o_orderkey").alias("game_id"),
        F.col("o_orderpriority").alias("map"),
        F.when(F.col("o_custkey") % 50 != 0, F.floor("o_totalprice") / 256).alias("avg_elo"),
        F.to_date("o_orderdate").alias("game_date"),
    )


def civ_dim(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        single_key("p_brand").alias("civ_pk"), F.col("p_brand").alias("civ_name")
    ).distinct()


def days(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar of the years the orders fall in."""
    from ladderlake.sources.calendar import calendar_between

    bounds = table(spark, sf, "orders").agg(
        F.to_date(F.date_trunc("year", F.min("o_orderdate"))).alias("first"),
        F.last_day(F.add_months(F.to_date(F.date_trunc("year", F.max("o_orderdate"))), 11)).alias(
            "last"
        ),
    )
    return calendar_between(bounds, "first", "last")


def keyed_days(spark: SparkSession, sf: str) -> DataFrame:
    from ladderlake.plans.silver import keyed_calendar

    return keyed_calendar(days(spark, sf))


# ---- the same in SQL -------------------------------------------------------
def quarter(day: str) -> str:
    return f"CAST(date_trunc('quarter', {day}) AS DATE)"


# Rating bands and their labels.
BUCKET = """CASE WHEN avg_elo <= 600 THEN '600 or less' WHEN avg_elo <= 800 THEN '600-800'
 WHEN avg_elo <= 1000 THEN '800-1000' WHEN avg_elo <= 1200 THEN '1000-1200'
 WHEN avg_elo <= 1400 THEN '1200-1400' WHEN avg_elo <= 1600 THEN '1400-1600'
 WHEN avg_elo <= 1800 THEN '1600-1800' WHEN avg_elo > 1800 THEN '1801 or more'
 ELSE 'unknown' END"""
WIN = "sum(CASE WHEN winner THEN 1 ELSE 0 END)"

CTES = {
    "raw_matches": f"""
SELECT floor(o_totalprice) / 256 AS avg_elo,
 (o_custkey % 3600 + 600) * 1000000000 + 750000000 AS duration,
 o_orderkey AS game_id, lower(o_orderpriority) AS game_speed, o_orderstatus AS game_type,
 (o_custkey % 1800 + 300) * 1000000000 + 250000000 AS irl_duration,
 CASE WHEN o_orderstatus = 'P' THEN 'team_random_map' ELSE 'random_map' END AS leaderboard,
 o_orderpriority AS map, o_custkey % 2 = 0 AS mirror, o_orderkey % 7 + 2 AS num_players,
 o_custkey % 10 + 100000 AS patch,
 CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey % 10 AS DOUBLE) END AS raw_match_type,
 o_orderkey % 2 = 0 AS replay_enhanced, o_orderdate AS started_timestamp,
 o_orderstatus AS starting_age, floor(o_totalprice) / 256 AS team_0_elo,
 floor(o_totalprice) / 512 AS team_1_elo, {quarter("o_orderdate")} AS file_date
FROM orders""",
    "matches_sr": f"""
SELECT CAST(avg_elo AS DECIMAL(38,2)) AS avg_elo,
 CAST(trunc(duration / 1000000000) AS INTEGER) AS game_duration_secs,
 CAST(game_id AS INTEGER) AS game_id, game_speed, game_type,
 CAST(trunc(irl_duration / 1000000000) AS INTEGER) AS actual_duration_secs,
 leaderboard, map, mirror, CAST(num_players AS INTEGER) AS num_players,
 CAST(patch AS VARCHAR) AS patch, CAST(raw_match_type AS VARCHAR) AS raw_match_type,
 replay_enhanced, started_timestamp, CAST(started_timestamp AS DATE) AS game_date,
 starting_age, CAST(trunc(team_0_elo) AS INTEGER) AS team_0_elo,
 CAST(trunc(team_1_elo) AS INTEGER) AS team_1_elo, '{MATCH_SOURCE}' AS source, file_date
FROM raw_matches WHERE leaderboard = 'random_map'""",
    "raw_players": f"""
SELECT lower(p_brand) AS civ, l_orderkey AS game_id, l_quantity - 25 AS match_rating_diff,
 CAST(floor(l_extendedprice / 64) AS BIGINT) AS new_rating,
 CAST(floor(l_extendedprice / 64) - floor(l_quantity) AS BIGINT) AS old_rating,
 CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS profile_id,
 l_linestatus AS replay_summary_raw, CAST(l_linenumber % 2 AS BIGINT) AS team,
 l_returnflag = 'R' AS winner, {quarter("l_shipdate")} AS file_date
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "players_sr": f"""
SELECT md5(concat_ws('~', CAST(game_id AS VARCHAR), CAST(profile_id AS VARCHAR))) AS id,
 CAST(game_id AS INTEGER) AS game_id, CAST(team AS VARCHAR) AS team,
 CAST(profile_id AS INTEGER) AS profile_id,
 upper(civ[1]) || lower(civ[2:]) AS civ_name, winner,
 CAST(trunc(match_rating_diff) AS INTEGER) AS match_rating_diff,
 CAST(new_rating AS INTEGER) AS new_rating, CAST(old_rating AS INTEGER) AS old_rating,
 '{MATCH_SOURCE}' AS source, file_date
FROM raw_players WHERE profile_id IS NOT NULL""",
    "players_one": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id
  ORDER BY file_date DESC, game_id DESC, team DESC, profile_id DESC, civ_name DESC,
   winner DESC, match_rating_diff DESC, new_rating DESC, old_rating DESC, source DESC) AS rn
 FROM players_sr) WHERE rn = 1""",
    "supplier_stats": """
SELECT supplier.*, wins, losses, last_played
FROM supplier JOIN (SELECT l_suppkey,
  CAST(count(*) FILTER (l_returnflag = 'R') AS INTEGER) AS wins,
  CAST(count(*) FILTER (l_returnflag = 'A') AS INTEGER) AS losses,
  max(l_shipdate) AS last_played FROM lineitem GROUP BY l_suppkey) ON s_suppkey = l_suppkey""",
    "leaderboards_sr": f"""
SELECT 0 AS disputes, 0 AS drops, CAST(s_suppkey + 1 AS INTEGER) AS highestrank,
 1 AS highestranklevel, CAST(trunc(s_acctbal) AS INTEGER) AS highestrating,
 last_played AS last_match_date, 3 AS leaderboard_id, losses,
 CAST(s_suppkey + 1 AS INTEGER) AS rank, 1 AS ranklevel,
 100 AS ranktotal, CAST(trunc(s_acctbal) AS INTEGER) AS rating,
 s_nationkey AS regionrank, 50 AS regionranktotal,
 CAST(s_suppkey + {GROUP_BASE} AS INTEGER) AS statgroup_id, wins - losses AS streak, wins,
 '{BOARD_SOURCE}' AS source
FROM supplier_stats""",
    "statgroup_sr": f"""
SELECT CAST(s_suppkey + {GROUP_BASE} AS INTEGER) AS id, '' AS group_name, 1 AS type,
 s_name AS alias, CASE WHEN s_nationkey < 20 THEN 'n' ELSE 'x' END || s_nationkey AS country, s_nationkey AS leaderboardregion_id,
 1 AS level, '/steam/' || s_suppkey AS name,
 CAST(s_suppkey + {GROUP_BASE} AS INTEGER) AS personal_statgroup_id,
 CAST(s_suppkey AS INTEGER) AS profile_id, 0 AS xp, '{BOARD_SOURCE}' AS source
FROM supplier_stats""",
    "countries": """
SELECT n_name AS Country, 'n' || n_nationkey AS Country_code FROM nation""",
    "standings": """
SELECT profile_id, alias AS gaming_name, s.country AS country_code,
 coalesce(c.Country, 'Unknown') AS country_name, statgroup_id, wins, losses,
 rank AS current_rank, rating AS current_rating, last_match_date, l.source
FROM leaderboards_sr l JOIN statgroup_sr s ON l.statgroup_id = s.personal_statgroup_id
 LEFT JOIN countries c ON s.country = c.Country_code""",
    "fact": f"""
SELECT md5(concat_ws('~', CAST(l_orderkey AS VARCHAR), '{MATCH_SOURCE}')) AS match_fk,
 md5(p_brand) AS civ_fk, CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS winner
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "match_dim": f"""
SELECT md5(concat_ws('~', CAST(o_orderkey AS VARCHAR), '{MATCH_SOURCE}')) AS match_pk,
 o_orderkey AS game_id, o_orderpriority AS map,
 CASE WHEN o_custkey % 50 <> 0 THEN floor(o_totalprice) / 256 END AS avg_elo,
 CAST(o_orderdate AS DATE) AS game_date
FROM orders""",
    "civ_dim": "SELECT DISTINCT md5(p_brand) AS civ_pk, p_brand AS civ_name FROM part",
    "days": """
SELECT CAST(d AS DATE) AS date, CAST(extract(year FROM d) AS INTEGER) AS year,
 CAST(extract(month FROM d) AS INTEGER) AS month, CAST(extract(day FROM d) AS INTEGER) AS day,
 CAST(extract(isodow FROM d) - 1 AS INTEGER) AS day_of_week,
 extract(isodow FROM d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
  date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
 FROM orders)""",
    "keyed_days": "SELECT *, CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_pk FROM days",
    "civ_view": f"""
SELECT civ_name AS civ, CAST(date_trunc('week', game_date) AS DATE) AS game_date, map,
 {BUCKET} AS match_elo_bucket, count(DISTINCT match_fk) AS matches_played,
 CAST({WIN} AS BIGINT) AS wins,
 round(CASE WHEN count(DISTINCT match_fk) = 0 THEN 0
  ELSE {WIN} / count(DISTINCT match_fk) * 100 END, 2) AS win_percentage
FROM fact JOIN match_dim ON match_fk = match_pk JOIN civ_dim ON civ_fk = civ_pk
GROUP BY 1, 2, 3, 4""",
    "opponent_view": f"""
SELECT c1.civ_name AS civ, c2.civ_name AS opponent_civ, map, {BUCKET} AS match_elo_bucket,
 count(DISTINCT f1.match_fk) AS matches_played,
 CAST({WIN.replace("winner", "f1.winner")} AS BIGINT) AS wins,
 round({WIN.replace("winner", "f1.winner")} / count(DISTINCT f1.match_fk) * 100, 2)
  AS win_percentage
FROM fact f1 JOIN fact f2 ON f1.match_fk = f2.match_fk JOIN match_dim ON f1.match_fk = match_pk
 JOIN civ_dim c1 ON f1.civ_fk = c1.civ_pk JOIN civ_dim c2 ON f2.civ_fk = c2.civ_pk
WHERE c1.civ_name <> c2.civ_name
GROUP BY 1, 2, 3, 4""",
    "leaderboard_view": """
SELECT gaming_name AS player_name, current_rank AS rank, current_rating AS rating,
 country_name AS country, round(wins / nullif(wins + losses, 0) * 100, 2) AS win_percentage,
 wins + losses AS total_matches, wins, losses, last_match_date AS last_played
FROM standings""",
}
# CTEs each view is made of, in order.
STAR = ("fact", "match_dim", "civ_dim")
CIV_VIEW = (*STAR, "civ_view")
OPPONENT_VIEW = (*STAR, "opponent_view")
STANDINGS = ("supplier_stats", "leaderboards_sr", "statgroup_sr", "countries", "standings")
LEADERBOARD_VIEW = (*STANDINGS, "leaderboard_view")
MATCHES = ("raw_matches", "matches_sr")
PLAYERS = ("raw_players", "players_sr")
