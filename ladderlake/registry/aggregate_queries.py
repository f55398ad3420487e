"""Aggregations, distincts, ordering and latest-row queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake.functions.columns import elo_bucket, percentage, week_start, win_flag
from ladderlake.operators import aggregates
from ladderlake.operators.joins import gathered_lineups, opposing_pairs, with_match
from ladderlake.operators.latest import latest_by_key
from ladderlake.operators.nested import explode_structs, flatten_members
from ladderlake.plans import views
from ladderlake.registry import register
from ladderlake.registry import stand_ins as s
from ladderlake.registry.stand_ins import table, with_ctes


def civ_view(spark, sf):
    return views.civ_performance(s.fact(spark, sf), s.match_dim(spark, sf), s.civ_dim(spark, sf))


def opponent_view(spark, sf):
    return views.opponent_civ(s.fact(spark, sf), s.match_dim(spark, sf), s.civ_dim(spark, sf))


@register(
    "agg_civ_performance",
    with_ctes(
        f"""SELECT civ_fk, CAST(date_trunc('week', game_date) AS DATE) AS game_date, map,
 {s.BUCKET} AS match_elo_bucket, count(DISTINCT match_fk) AS matches_played,
 CAST({s.WIN} AS BIGINT) AS wins,
 round({s.WIN} / count(DISTINCT match_fk) * 100, 2) AS win_percentage
FROM fact JOIN match_dim ON match_fk = match_pk GROUP BY 1, 2, 3, 4""",
        "fact", "match_dim",
    ),
)
def agg_civ_performance(spark, sf):
    per_match = with_match(
        aggregates.lineups(s.fact(spark, sf)),
        s.match_dim(spark, sf),
        week_start("game_date").alias("game_date"),
        "map",
        elo_bucket("avg_elo").alias("match_elo_bucket"),
    )
    return aggregates.matches_and_wins(
        per_match, "civ_fk", "game_date", "map", "match_elo_bucket"
    )


@register(
    "agg_opponent_civ",
    with_ctes(
        f"""SELECT f1.civ_fk AS civ_fk, f2.civ_fk AS opponent_civ_fk, map,
 count(DISTINCT f1.match_fk) AS matches_played,
 CAST({s.WIN.replace("winner", "f1.winner")} AS BIGINT) AS wins,
 round({s.WIN.replace("winner", "f1.winner")} / count(DISTINCT f1.match_fk) * 100, 2)
  AS win_percentage
FROM fact f1 JOIN fact f2 ON f1.match_fk = f2.match_fk AND f1.civ_fk <> f2.civ_fk
 JOIN match_dim ON f1.match_fk = match_pk GROUP BY 1, 2, 3""",
        "fact", "match_dim",
    ),
)
def agg_opponent_civ(spark, sf):
    gathered = gathered_lineups(aggregates.lineups(s.fact(spark, sf)), "match_fk", "civ_fk")
    per_match = with_match(gathered, s.match_dim(spark, sf), "map")
    pairs = opposing_pairs(per_match, "map").withColumnsRenamed(
        {"civ": "civ_fk", "opponent_civ": "opponent_civ_fk"}
    )
    return aggregates.matches_and_wins(pairs, "civ_fk", "opponent_civ_fk", "map")


@register(
    "agg_count_distinct",
    """SELECT p_brand, count(DISTINCT l_orderkey) AS matches_played
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def agg_count_distinct(spark, sf):
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem")
    return (
        lines.join(brands, lines.l_partkey == brands.p_partkey)
        .groupBy("p_brand")
        .agg(F.count_distinct("l_orderkey").alias("matches_played"))
    )


@register(
    "agg_conditional_sum",
    """SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'N' THEN 0
  WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS wins
FROM lineitem GROUP BY l_suppkey""",
)
def agg_conditional_sum(spark, sf):
    winner = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") == "R")
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(win_flag(winner)).alias("wins")
    )


@register(
    "agg_ratio_guarded",
    """SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS wins,
 count(*) FILTER (o_orderstatus <> 'P') AS matches_played,
 CASE WHEN count(*) FILTER (o_orderstatus <> 'P') = 0 THEN 0.0::DOUBLE
  ELSE round(count(*) FILTER (o_orderstatus = 'F')
   / nullif(count(*) FILTER (o_orderstatus <> 'P'), 0) * 100, 2) END AS win_percentage
FROM orders GROUP BY o_custkey""",
)
def agg_ratio_guarded(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("wins"),
        F.count_if(F.col("o_orderstatus") != "P").alias("matches_played"),
    )
    return counts.withColumn("win_percentage", percentage("wins", "matches_played"))


@register(
    "rollup_civ_opponent",
    with_ctes(
        """SELECT civ, opponent_civ, CAST(sum(matches_played) AS BIGINT) AS matches_played,
 CAST(sum(wins) AS BIGINT) AS wins,
 round(sum(wins) / sum(matches_played) * 100, 2) AS win_percentage
FROM opponent_view GROUP BY civ, opponent_civ""",
        *s.OPPONENT_VIEW,
    ),
)
def rollup_civ_opponent(spark, sf):
    return aggregates.roll_up(opponent_view(spark, sf), "civ", "opponent_civ")


@register(
    "rollup_civ_trend",
    with_ctes(
        """SELECT civ, map, match_elo_bucket, game_date,
 CAST(sum(matches_played) AS BIGINT) AS matches_played, CAST(sum(wins) AS BIGINT) AS wins,
 round(sum(wins) / sum(matches_played) * 100, 2) AS win_percentage
FROM civ_view GROUP BY civ, map, match_elo_bucket, game_date""",
        *s.CIV_VIEW,
    ),
)
def rollup_civ_trend(spark, sf):
    return aggregates.roll_up(
        civ_view(spark, sf), "civ", "map", "match_elo_bucket", "game_date"
    )


@register(
    "agg_last_updated",
    """SELECT strftime(max(ts), '%Y-%m-%d, %I:%M %p') AS last_updated FROM events""",
)
def agg_last_updated(spark, sf):
    return aggregates.last_updated(table(spark, sf, "events"), "ts")


@register(
    "distinct_filter_values",
    "SELECT DISTINCT p_brand AS choice FROM part ORDER BY choice",
)
def distinct_filter_values(spark, sf):
    return aggregates.choices(table(spark, sf, "part"), "p_brand")


@register(
    "distinct_rows",
    "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_quantity FROM lineitem",
)
def distinct_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity").distinct()


@register(
    "drop_duplicates_rows",
    "SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate FROM lineitem",
)
def drop_duplicates_rows(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_shipdate").dropDuplicates()


@register("agg_count_all", "SELECT count(*) AS n FROM lineitem")
def agg_count_all(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


# ---- latest row, order -----------------------------------------------------
LINE_COLUMNS = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)
_LATEST_LINE = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, {", ".join(f"{c} DESC" for c in LINE_COLUMNS)}) AS rn
 FROM lineitem) WHERE rn = 1"""


@register("dedup_latest_by_key", _LATEST_LINE)
def dedup_latest_by_key(spark, sf):
    lines = table(spark, sf, "lineitem")
    return latest_by_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", LINE_COLUMNS)


@register(
    "latest_rank_filter",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (
  PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""",
)
def latest_rank_filter(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_by_key(orders, "o_custkey", "o_orderdate")


@register(
    "sort_multi_asc",
    with_ctes(
        "SELECT * FROM civ_view ORDER BY civ, map, match_elo_bucket, game_date", *s.CIV_VIEW
    ),
)
def sort_multi_asc(spark, sf):
    return civ_view(spark, sf).orderBy(*views.CIV_PERFORMANCE_ORDER)


@register(
    "sort_rank_asc",
    with_ctes(
        """SELECT rank, player_name, rating, country FROM leaderboard_view ORDER BY rank""",
        *s.LEADERBOARD_VIEW,
    ),
)
def sort_rank_asc(spark, sf):
    board = views.leaderboard(s.standings(spark, sf))
    return board.select("rank", "player_name", "rating", "country").orderBy(
        *views.LEADERBOARD_ORDER
    )


# ---- nested ----------------------------------------------------------------
@register(
    "struct_expand",
    with_ctes(
        """SELECT statgroup_id, leaderboard_id, wins, losses, streak, rank + shift AS rank, rating
FROM leaderboards_sr, (VALUES (0), (1)) AS t(shift)""",
        "supplier_stats", "leaderboards_sr",
    ),
)
def struct_expand(spark, sf):
    return explode_structs(s.leaderboard_pages(spark, sf), "leaderboardStats").select(
        "statgroup_id", "leaderboard_id", "wins", "losses", "streak", "rank", "rating"
    )


@register(
    "nested_field",
    with_ctes(
        """SELECT profile_id::BIGINT AS profile_id, id, country, alias, name
FROM statgroup_sr, (VALUES (0), (1)) AS t(twice)""",
        "supplier_stats", "statgroup_sr",
    ),
)
def nested_field(spark, sf):
    return flatten_members(s.leaderboard_pages(spark, sf)).select(
        "profile_id", "id", "country", "alias", "name"
    )


@register(
    "fn_explode",
    with_ctes(
        """SELECT page, CAST(count(*) AS BIGINT) AS members, min(alias) AS first_alias FROM (
 SELECT CAST(floor(profile_id / 25) AS BIGINT) AS page, alias
 FROM statgroup_sr, (VALUES (0), (1)) AS t(twice)) GROUP BY page""",
        "supplier_stats", "statgroup_sr",
    ),
)
def fn_explode(spark, sf):
    return (
        flatten_members(s.leaderboard_pages(spark, sf), "page")
        .groupBy("page")
        .agg(F.count(F.lit(1)).alias("members"), F.min("alias").alias("first_alias"))
    )
