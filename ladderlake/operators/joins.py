"""Joins of the star schema and its lookups.

Strategy is left to Catalyst: a side whose known size is under
`spark.sql.autoBroadcastJoinThreshold` is broadcast, any other is shuffled on the join
key, where adaptive execution splits the partitions of hot keys. `broadcast_if_under`
adds a row-count check for stored tables whose byte size is not known to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderlake.functions.columns import packed_text, unpacked_text

# Row limit under which a small dimension is broadcast: the calendar has one row per day and
# civs are a fixed roster, so both stay far below; beyond, the join shuffles.
BROADCAST_ROWS = 100_000


def broadcast_if_under(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting the rows; beyond the limit, join as usual.

    The count of a stored table reads file footers only. That of a derived one runs its plan
    once more, which a roster of names is worth: without the hint every fact row would be
    shuffled on a handful of civs.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lookup_with_default(
    df: DataFrame, lookup: DataFrame, on: Column, value: str, default: str, alias: str
) -> DataFrame:
    """Left join to a lookup; rows it does not know get the default."""
    known = F.coalesce(F.col(value), F.lit(default)).alias(alias)
    return df.join(lookup, on, "left").select(*[df[c] for c in df.columns], known)


def star_fact(
    players: DataFrame, civs: DataFrame, matches: DataFrame, people: DataFrame, days: DataFrame
) -> DataFrame:
    """Replace the natural keys of player-match rows by those of four dimensions.

    All joins are inner: a row without its civ, match, player or date is not a fact. The
    date depends on the match only, so it is joined to the matches, before the far larger
    player rows come in. Each side carries just the columns the fact needs, keys packed, since
    digests are most of what is shuffled. The civs are broadcast after a check of their number.
    """
    keyed_matches = matches.select("game_id", packed_text("match_pk").alias("match_fk"), "game_date")
    dated_matches = keyed_matches.join(
        days.select(F.col("date").alias("game_date"), F.col("date_pk").alias("date_fk")),
        "game_date",
    )
    return (
        players.join(
            broadcast_if_under(civs.select("civ_name", F.col("civ_pk").alias("civ_fk"))), "civ_name"
        )
        .join(dated_matches, "game_id")
        .join(people.select("profile_id", F.col("player_pk").alias("player_fk")), "profile_id")
        .select(
            F.col("id").alias("fact_pk"),
            "player_fk",
            unpacked_text("match_fk").alias("match_fk"),
            "civ_fk",
            "date_fk",
            "team",
            "winner",
            "match_rating_diff",
            "new_rating",
            "old_rating",
            "source",
            "file_date",
        )
    )


def with_match(df: DataFrame, matches: DataFrame, *attributes: str | Column) -> DataFrame:
    """Attach attributes of the match dimension through `match_fk`."""
    return df.join(matches.select(F.col("match_pk").alias("match_fk"), *attributes), "match_fk")


def with_civ(
    df: DataFrame,
    civs: DataFrame,
    fk: str = "civ_fk",
    alias: str = "civ",
    checked: bool = False,
) -> DataFrame:
    """Replace a civ key by the civ's name; civs are broadcast after a check of their number.

    The check runs a job: who joins the same civs several times passes them `checked`, as
    `broadcast_if_under` gives them.
    """
    names = civs.select(F.col("civ_pk").alias(fk), F.col("civ_name").alias(alias))
    return df.join(names if checked else broadcast_if_under(names), fk).drop(fk)


def gathered_lineups(lineups: DataFrame, match: str, civ: str) -> DataFrame:
    """One row per match with its whole line-up: `lineup`, an array of civ, players, wins.

    `lineups` holds one row per match and civ, so the array has at most as many entries as
    there are civs, however many players a hot match had.
    """
    entry = F.struct(F.col(civ).alias("civ"), "players", "wins")
    return lineups.groupBy(match).agg(F.collect_list(entry).alias("lineup"))


def opposing_pairs(matches: DataFrame, *keep: str) -> DataFrame:
    """Pair each civ of a gathered line-up with every other civ of it.

    The pair carries the number of player pairs it stands for and the wins among them,
    which is what a self join of the players would yield, from one scan instead of two.
    Pairs of a match are bounded by the civs, not by the players.
    """
    mine = matches.select(*keep, "lineup", F.inline("lineup"))
    return (
        mine.select(*keep, "civ", "players", "wins", F.explode("lineup").alias("_other"))
        .filter(F.col("civ") != F.col("_other.civ"))
        .select(
            *keep,
            "civ",
            F.col("_other.civ").alias("opponent_civ"),
            (F.col("players") * F.col("_other.players")).alias("player_pairs"),
            (F.col("wins") * F.col("_other.players")).alias("wins"),
        )
    )


def split_by_match(src: DataFrame, tgt: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Source rows whose key the target holds, and those it does not (null keys never match)."""
    held = tgt.select(key)
    return src.join(held, key, "left_semi"), src.join(held, key, "left_anti")


def mark_matches(src: DataFrame, tgt: DataFrame, key: str, flag: str = "matched") -> DataFrame:
    """Source rows with a flag whether the target holds their key, from one join."""
    held = tgt.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return src.join(held, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
