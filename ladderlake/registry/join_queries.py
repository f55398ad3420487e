"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake.operators.aggregates import lineups
from ladderlake.operators.joins import (
    gathered_lineups,
    lookup_with_default,
    mark_matches,
    opposing_pairs,
    star_fact,
    with_civ,
    with_match,
)
from ladderlake.plans import gold, silver
from ladderlake.registry import register
from ladderlake.registry import stand_ins as s
from ladderlake.registry.stand_ins import table, with_ctes

FACT_SQL = f"""
SELECT p.id AS fact_pk,
 md5(concat_ws('~', CAST(d.profile_id AS VARCHAR), '{s.BOARD_SOURCE}')) AS player_fk,
 md5(concat_ws('~', CAST(m.game_id AS VARCHAR), '{s.MATCH_SOURCE}')) AS match_fk,
 md5(c.civ_name) AS civ_fk, k.date_pk AS date_fk, p.team, p.winner, p.match_rating_diff,
 p.new_rating, p.old_rating, p.source, p.file_date
FROM players_one p JOIN civ_dim c ON p.civ_name = c.civ_name
 JOIN matches_sr m ON p.game_id = m.game_id
 JOIN standings d ON p.profile_id = d.profile_id
 JOIN keyed_days k ON m.game_date = k.date"""
FACT_CTES = (
    *s.PLAYERS, "players_one", "civ_dim", *s.MATCHES, *s.STANDINGS, "days", "keyed_days"
)


def star_inputs(spark, sf):
    """Player rows and the four dimensions, each built from its own table."""
    all_dates = ("1900-01-01", "2999-12-31")
    return (
        s.unique_players(spark, sf),
        s.civ_dim(spark, sf),
        gold.match_dimension(silver.typed_matches(s.bronze_matches(spark, sf)), all_dates),
        gold.player_dimension(s.standings(spark, sf)),
        s.keyed_days(spark, sf),
    )


@register("join_star_fact", with_ctes(FACT_SQL, *FACT_CTES))
def join_star_fact(spark, sf):
    return star_fact(*star_inputs(spark, sf))


@register(
    "join_inner_equi",
    with_ctes(
        """SELECT statgroup_id, profile_id, alias, wins, losses
FROM leaderboards_sr JOIN statgroup_sr ON statgroup_id = personal_statgroup_id""",
        "supplier_stats", "leaderboards_sr", "statgroup_sr",
    ),
)
def join_inner_equi(spark, sf):
    pages = s.bronze_pages(spark, sf)
    boards, groups = silver.current_leaderboards(pages), silver.current_statgroups(pages)
    return boards.join(
        groups, boards.statgroup_id == groups.personal_statgroup_id
    ).select("statgroup_id", "profile_id", "alias", "wins", "losses")


@register(
    "join_left_lookup_default",
    """SELECT c_custkey, c_nationkey, coalesce(n_name, 'Unknown') AS country_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_nationkey < 20""",
)
def join_left_lookup_default(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    # Some codes of the customers' side are not in the lookup.
    code = F.when(F.col("c_nationkey") < 20, F.col("c_nationkey"))
    return lookup_with_default(
        customers, nations, code == F.col("n_nationkey"),
        value="n_name", default="Unknown", alias="country_name",
    )


@register(
    "join_fact_dims_view",
    with_ctes(
        """SELECT game_id, civ_name AS civ, map, game_date, count(*) AS players,
 CAST(sum(CASE WHEN winner THEN 1 ELSE 0 END) AS BIGINT) AS wins
FROM fact JOIN match_dim ON match_fk = match_pk JOIN civ_dim ON civ_fk = civ_pk
GROUP BY ALL""",
        *s.STAR,
    ),
)
def join_fact_dims_view(spark, sf):
    joined = with_match(
        lineups(s.fact(spark, sf)), s.match_dim(spark, sf), "game_id", "map", "game_date"
    )
    return with_civ(joined, s.civ_dim(spark, sf)).drop("match_fk")


@register(
    "join_self_theta",
    """WITH f AS (SELECT l_orderkey, p_brand AS civ, l_returnflag = 'R' AS winner
 FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT a.l_orderkey, a.civ, b.civ AS opponent_civ, count(*) AS player_pairs,
 CAST(sum(CASE WHEN a.winner THEN 1 ELSE 0 END) AS BIGINT) AS wins
FROM f a JOIN f b ON a.l_orderkey = b.l_orderkey AND a.civ <> b.civ GROUP BY 1, 2, 3""",
)
def join_self_theta(spark, sf):
    brands = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem")
    per_match = (
        lines.join(brands, lines.l_partkey == brands.p_partkey)
        .groupBy("l_orderkey", F.col("p_brand").alias("civ"))
        .agg(
            F.count(F.lit(1)).alias("players"),
            F.count_if(F.col("l_returnflag") == "R").alias("wins"),
        )
    )
    return opposing_pairs(gathered_lineups(per_match, "l_orderkey", "civ"), "l_orderkey")


@register(
    "join_merge_match",
    """SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem
  WHERE l_returnflag = 'R') AS matched FROM orders""",
)
def join_merge_match(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    won = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey")
    )
    return mark_matches(orders, won, "o_orderkey")
