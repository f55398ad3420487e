"""Projections and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderlake.functions import columns as c
from ladderlake.plans import views
from ladderlake.plans.pages import LEADERBOARD_LABELS
from ladderlake.registry import register
from ladderlake.registry import stand_ins as s
from ladderlake.registry.stand_ins import table, with_ctes
from ladderlake.sources.scans import with_provenance


@register(
    "add_provenance",
    """SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, 'lineitem.parquet' AS fn,
 'PLAYER_FEED' AS source, DATE '2024-01-02' AS loaded_on FROM lineitem""",
)
def add_provenance(spark, sf):
    """File name, source tag, row dedup and load time of a scan."""
    scan = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    stamped = with_provenance(scan, "PLAYER_FEED", loaded_at=F.lit("2024-01-02").cast("timestamp"))
    return stamped.select(
        "l_orderkey", "l_linenumber", "l_quantity", "fn", "source",
        F.to_date("ldts").alias("loaded_on"),
    )


@register(
    "derive_file_date",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END
 AS file_date FROM events""",
)
def derive_file_date(spark, sf):
    """Files named by date give it; a file named otherwise gives none."""
    name = F.when(F.col("event_type") == "error", "manifest.parquet").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(".parquet"))
    )
    return table(spark, sf, "events").select("event_id", c.file_date_of(name).alias("file_date"))


@register(
    "conform_schema",
    """SELECT CAST(trunc(l_quantity) AS INTEGER) AS rating,
 CAST(l_orderkey AS INTEGER) AS game_id, CAST(l_linenumber AS VARCHAR) AS team,
 CAST(CAST(floor(l_extendedprice) / 256 AS DECIMAL(38,2)) AS DOUBLE) AS elo,
 CAST(l_shipdate AS DATE) AS game_date FROM lineitem""",
)
def conform_schema(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("game_date"),
        F.col("l_orderkey").alias("game_id"),
        (F.floor("l_extendedprice") / 256).alias("elo"),
        F.col("l_linenumber").alias("team"),
        F.col("l_quantity").alias("rating"),
        F.col("l_tax").alias("not_in_layout"),
    )
    typed = c.conform(
        lines, "rating int, game_id int, team string, elo decimal(38,2), game_date date"
    )
    return typed.withColumn("elo", F.col("elo").cast("double"))


@register(
    "select_rename",
    "SELECT c_custkey AS profile_id, c_name AS gaming_name, c_mktsegment AS country_code "
    "FROM customer",
)
def select_rename(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("profile_id"),
        F.col("c_name").alias("gaming_name"),
        F.col("c_mktsegment").alias("country_code"),
    )


@register(
    "surrogate_key_md5",
    """SELECT event_id, md5(concat_ws('~', CAST(user_id AS VARCHAR),
 CASE WHEN event_type <> 'view' THEN event_type END)) AS pk FROM events""",
)
def surrogate_key_md5(spark, sf):
    """A null part is left out of the hashed text."""
    part = F.when(F.col("event_type") != "view", F.col("event_type"))
    return table(spark, sf, "events").select("event_id", c.composite_key("user_id", part).alias("pk"))


@register(
    "hash_key_single",
    """SELECT p_partkey, CASE WHEN p_size > 10 THEN md5(p_brand) END AS civ_pk FROM part""",
)
def hash_key_single(spark, sf):
    civ = F.when(F.col("p_size") > 10, F.col("p_brand"))
    return table(spark, sf, "part").select("p_partkey", c.single_key(civ).alias("civ_pk"))


@register(
    "smart_date_key",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_pk
FROM orders""",
)
def smart_date_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", c.date_key("o_orderdate").alias("date_pk"))


@register(
    "constant_columns",
    """SELECT DISTINCT p_brand AS civ_name, '' AS civ_weaknesses, '' AS civ_strengths,
 'MATCH_FEED' AS source FROM part""",
)
def constant_columns(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("civ_name"),
        F.lit("").alias("civ_weaknesses"),
        F.lit("").alias("civ_strengths"),
        F.lit(s.MATCH_SOURCE).cast("string").alias("source"),
    ).distinct()


@register(
    "audit_columns",
    """SELECT o_orderkey, DATE '2024-01-02' AS load_date,
 TIMESTAMP '2024-01-02 21:05:00' AS ldts, true AS stamped_now FROM orders""",
)
def audit_columns(spark, sf):
    """Pinned load stamps, and that the unpinned ones are the time of the run."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        c.load_date(F.lit("2024-01-02").cast("date")).alias("load_date"),
        c.load_time(F.lit("2024-01-02 21:05:00").cast("timestamp_ntz")).alias("ldts"),
        (F.to_date(c.load_time()) == c.load_date()).alias("stamped_now"),
    )


@register(
    "bucketize_elo",
    with_ctes(
        f"SELECT game_id, avg_elo, {s.BUCKET} AS match_elo_bucket FROM match_dim", "match_dim"
    ),
)
def bucketize_elo(spark, sf):
    return s.match_dim(spark, sf).select(
        "game_id", "avg_elo", c.elo_bucket("avg_elo").alias("match_elo_bucket")
    )


@register(
    "nanos_to_secs",
    """SELECT event_id, CAST(trunc(CAST(trunc((value - 20) * 1000) AS BIGINT) * 1000000
 / 1000000000) AS INTEGER) AS secs FROM events""",
)
def nanos_to_secs(spark, sf):
    """Durations below zero are cut off toward zero as well."""
    nanos = ((F.col("value") - 20) * 1000).cast("bigint") * 1_000_000
    return table(spark, sf, "events").select("event_id", c.nanos_to_secs(nanos).alias("secs"))


@register(
    "rename_lower",
    "SELECT c_custkey AS profile_id, c_name AS gaming_name, c_acctbal AS rating FROM customer",
)
def rename_lower(spark, sf):
    return c.lower_names(
        table(spark, sf, "customer").select(
            F.col("c_custkey").alias("Profile_ID"),
            F.col("c_name").alias("GAMING_NAME"),
            F.col("c_acctbal").alias("Rating"),
        )
    )


@register(
    "display_rename",
    with_ctes(
        """SELECT player_name AS "Player Name", rank AS "Rank", rating AS "Rating",
 country AS "Country", win_percentage AS "Win Percent", total_matches AS "Total Matches",
 wins AS "Wins", losses AS "Losses" FROM leaderboard_view""",
        *s.LEADERBOARD_VIEW,
    ),
)
def display_rename(spark, sf):
    board = views.leaderboard(s.standings(spark, sf)).drop("last_played")
    return board.withColumnsRenamed(LEADERBOARD_LABELS)


@register("drop_column", "SELECT * EXCLUDE (props) FROM events")
def drop_column(spark, sf):
    return table(spark, sf, "events").drop("props")
