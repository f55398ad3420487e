from __future__ import annotations

import re
import random
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from ladderlake import schemas
from ladderlake.functions.columns import elo_bucket
from ladderlake.operators import joins
from ladderlake.operators.aggregates import choices, last_updated, lineups, roll_up
from ladderlake.operators.filters import outside, selected
from ladderlake.operators.latest import latest_by_key
from ladderlake.operators.nested import explode_structs, flatten_members
from ladderlake.plans import gold, pages, silver, views
from ladderlake.sources.calendar import calendar


# ---- latest ----------------------------------------------------------------
def test_ties_do_not_depend_on_partitioning(spark):
    data = [(k, datetime(2024, 1, 1 + i % 2), i % 5) for k in range(20) for i in range(40)]
    picks = set()
    for seed, parts in ((1, 1), (2, 7), (3, 16)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, at timestamp, v int").repartition(parts)
        picks.add(tuple(rows(latest_by_key(df, "k", "at"))))
    expected = tuple(sorted(((k, datetime(2024, 1, 2), 4) for k in range(20)), key=repr))
    assert picks == {expected}


def test_null_dates_come_last(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, datetime(2020, 1, 1), "y"), (2, None, "z")],
        "k int, at timestamp, v string",
    )
    assert rows(latest_by_key(df, "k", "at").select("k", "v")) == [(1, "y"), (2, "z")]


def test_ranking_starts_before_the_shuffle(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    text = plan(latest_by_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate"))
    assert text.count("WindowGroupLimit") == 2


# ---- filters ---------------------------------------------------------------
def test_outside_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "v int")
    assert rows(df.filter(outside("v", 2, 8))) == [(1,), (9,)]


def test_empty_choice_keeps_all(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "x string, y int")
    assert selected(df, {"x": [], "y": []}).count() == 3
    assert rows(selected(df, {"x": ["b"], "y": [1, 3]})) == [("b", 1)]


# ---- joins -----------------------------------------------------------------
def test_lookup_default(spark):
    people = spark.createDataFrame([(1, "se"), (2, "xx"), (3, None)], "id int, cd string")
    names = spark.createDataFrame([("se", "Sweden")], "code string, name string")
    out = joins.lookup_with_default(
        people, names, F.col("cd") == F.col("code"), "name", "Unknown", "country"
    )
    assert rows(out) == [(1, "se", "Sweden"), (2, "xx", "Unknown"), (3, None, "Unknown")]


def test_broadcast_only_under_the_limit(spark):
    big, small = spark.range(50).toDF("k"), spark.range(5).toDF("k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = plan(big.join(joins.broadcast_if_under(small, 10), "k"))
        shuffled = plan(big.join(joins.broadcast_if_under(small, 4), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in hinted
    assert "SortMergeJoin" in shuffled and "Broadcast" not in shuffled


def test_hot_keys_are_split_by_the_fact_join(spark):
    """A third of all rows belongs to one match and one profile; dimensions are not broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    n = 60_000
    hot = F.when(F.col("id") % 3 == 0, 0)
    players = spark.range(0, n, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("id"),
        hot.otherwise(F.col("id") % 5000).cast("int").alias("game_id"),
        F.lit("1").alias("team"),
        hot.otherwise(F.col("id") % 700).cast("int").alias("profile_id"),
        F.concat(F.lit("Civ"), F.col("id") % 7).alias("civ_name"),
        (F.col("id") % 2 == 0).alias("winner"),
        *[F.lit(1).alias(c) for c in ("match_rating_diff", "new_rating", "old_rating")],
        F.lit("S").alias("source"),
        F.lit(date(2024, 1, 7)).alias("file_date"),
    )
    matches = spark.range(5000).select(
        F.col("id").cast("int").alias("game_id"),
        F.col("id").cast("string").alias("match_pk"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 9).cast("int")).alias("game_date"),
    )
    people = spark.range(700).select(
        F.col("id").cast("int").alias("profile_id"), F.col("id").cast("string").alias("player_pk")
    )
    civs = gold.civ_dimension(players)
    days = silver.keyed_calendar(calendar(spark))
    for key, setting in settings.items():
        spark.conf.set(key, setting)
    try:
        fact = joins.star_fact(players, civs, matches, people, days)
        assert len(fact.collect()) == n
        text = plan(fact)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_fact_row_is_shuffled_on_its_civ(spark, sf):
    """Civs are broadcast after their number was checked, whatever statistics say."""
    from ladderlake.plans import views
    from ladderlake.registry import stand_ins as s
    from ladderlake.registry.join_queries import star_inputs

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, matches, civs = s.fact(spark, sf), s.match_dim(spark, sf), s.civ_dim(spark, sf)
        for df in (
            joins.star_fact(*star_inputs(spark, sf)),
            views.civ_performance(fact, matches, civs),
            views.opponent_civ(fact, matches, civs),
        ):
            exchanges = [x for x in plan(df).splitlines() if "Exchange hashpartitioning" in x]
            alone = [x for x in exchanges if re.search(r"hashpartitioning\((opponent_)?civ_(fk|name)#\d+, ", x)]
            # Only the roster itself is made distinct by such an exchange.
            assert exchanges and all("ENSURE" in x for x in exchanges)
            assert "BroadcastHashJoin" in plan(df)
            assert len(alone) <= plan(df).count("civ_pk"), alone
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_civs_are_made_distinct_before_they_are_hashed(spark):
    players = spark.createDataFrame([("a",), ("b",), ("a",)], "civ_name string")
    assert re.search(r"HashAggregate\(keys=\[civ_name#\d+\]", plan(gold.civ_dimension(players)))


def test_matches_are_flagged_by_one_join(spark):
    src = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    tgt = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    out = joins.mark_matches(src, tgt, "k")
    assert rows(out) == [(1, False), (2, True), (2, True), (None, False)]


# ---- nested ----------------------------------------------------------------
def test_empty_and_missing_arrays_yield_no_rows(spark):
    text = [
        '{"statGroups": [{"id": 1, "name": "g", "members": [{"profile_id": 9, "alias": "a"}]}, '
        '{"id": 2, "members": []}, {"id": 3}], "leaderboardStats": [{"statgroup_id": 1}]}',
        '{"statGroups": [], "leaderboardStats": []}',
        "{}",
    ]
    docs = spark.createDataFrame([(t,) for t in text], "body string").select(
        F.inline(F.array(F.from_json("body", schemas.struct(schemas.RAW_LEADERBOARD_PAGE))))
    )
    members = flatten_members(docs).select("id", "group_name", "profile_id", "alias")
    assert rows(members) == [(1, "g", 9, "a")]
    assert explode_structs(docs, "leaderboardStats").count() == 1


# ---- views against brute force ---------------------------------------------
CIVS = ["Aztecs", "Britons", "Celts", "Danes", "Ethiopians"]


def star(spark, seed):
    """A small star; one match holds a third of all player rows, some facts lack a dimension."""
    rng = random.Random(seed)
    matches = [
        (f"m{i}", rng.choice(["arena", "islands"]), rng.choice([None, 500.0, 600.0, 1900.0]),
         date(2024, 1, 1 + rng.randrange(20)))
        for i in range(25)
    ]
    fact = []
    for _ in range(150):
        match = "m0" if rng.random() < 0.33 else f"m{rng.randrange(27)}"
        civ = rng.choice([*CIVS, "Unlisted"])
        fact.append((match, f"k-{civ}", rng.choice([True, False, None])))
    return fact, matches, [(f"k-{c}", c) for c in CIVS]


def frames(spark, fact, matches, civs):
    return (
        spark.createDataFrame(fact, "match_fk string, civ_fk string, winner boolean"),
        spark.createDataFrame(
            matches, "match_pk string, map string, avg_elo double, game_date date"
        ),
        spark.createDataFrame(civs, "civ_pk string, civ_name string"),
    )


def bucket(rating):
    if rating is None:
        return "unknown"
    return "600 or less" if rating <= 600 else "1801 or more"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_opponent_view(spark, seed):
    fact, matches, civs = star(spark, seed)
    where, names = {m[0]: m for m in matches}, dict(civs)
    played, wins = defaultdict(set), defaultdict(int)
    for m1, c1, won in fact:
        for m2, c2, _ in fact:
            if m1 == m2 and m1 in where and c1 in names and c2 in names and c1 != c2:
                key = (names[c1], names[c2], where[m1][1], bucket(where[m1][2]))
                played[key].add(m1)
                wins[key] += won is True
    got = views.opponent_civ(*frames(spark, fact, matches, civs))
    assert {tuple(r)[:4]: (r["matches_played"], r["wins"]) for r in got.collect()} == {
        k: (len(v), wins[k]) for k, v in played.items()
    }


@pytest.mark.parametrize("seed", [4, 5])
def test_civ_view(spark, seed):
    fact, matches, civs = star(spark, seed)
    where, names = {m[0]: m for m in matches}, dict(civs)
    played, wins = defaultdict(set), defaultdict(int)
    for m, c, won in fact:
        if m in where and c in names:
            day = where[m][3]
            monday = date.fromordinal(day.toordinal() - day.weekday())
            key = (names[c], monday, where[m][1], bucket(where[m][2]))
            played[key].add(m)
            wins[key] += won is True
    got = views.civ_performance(*frames(spark, fact, matches, civs)).collect()
    assert {tuple(r)[:4]: (r["matches_played"], r["wins"]) for r in got} == {
        k: (len(v), wins[k]) for k, v in played.items()
    }
    for r in got:
        assert abs(r["win_percentage"] - 100 * r["wins"] / r["matches_played"]) <= 0.00501


def test_a_hot_match_shrinks_to_its_lineup(spark):
    """However many players a match has, it has one row per civ from the first shuffle on."""
    fact = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("match_fk"),
        (F.col("id") % 30).cast("string").alias("civ_fk"),
        (F.col("id") % 2 == 0).alias("winner"),
    )
    hot = lineups(fact).filter("match_fk = 'hot'")
    assert hot.count() == 10
    assert joins.opposing_pairs(joins.gathered_lineups(hot, "match_fk", "civ_fk")).count() == 90
    text = plan(lineups(fact))
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")


def test_views_scan_each_table_once(spark, tmp_path):
    fact, matches, civs = star(spark, 1)
    stored = []
    for i, df in enumerate(frames(spark, fact, matches, civs)):
        df.write.parquet(str(tmp_path / str(i)))
        stored.append(spark.read.parquet(str(tmp_path / str(i))))
    text = plan(views.opponent_civ(*stored))
    assert text.count("match_fk#") and text.count("ReadSchema: struct<match_fk") == 1
    assert text.count("ReadSchema: struct<match_pk") == 1
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_leaderboard_without_matches(spark):
    people = spark.createDataFrame(
        [("a", 2, 1500, "Sweden", 3, 1, datetime(2024, 1, 1)), ("b", 1, 1600, "Norway", 0, 0, None)],
        "gaming_name string, current_rank int, current_rating int, country_name string, "
        "wins int, losses int, last_match_date timestamp",
    )
    out = views.leaderboard(people).orderBy("rank").collect()
    assert [(r["player_name"], r["win_percentage"], r["total_matches"]) for r in out] == [
        ("b", None, 0), ("a", 75.0, 4)
    ]


def test_pages(spark):
    view = spark.createDataFrame(
        [
            ("A", "B", "arena", "600-800", 4, 1), ("A", "B", "islands", "600-800", 4, 3),
            ("A", "C", "arena", "600-800", 0, 0),
        ],
        "civ string, opponent_civ string, map string, match_elo_bucket string, "
        "matches_played bigint, wins bigint",
    )
    page = pages.civ_compare_page(view, {"map": [], "opponent_civ": ["B"]})
    assert page.columns == list(pages.CIV_COMPARE_LABELS.values())
    assert rows(page) == [("A", "B", 8, 4, 50.0)]
    assert rows(roll_up(view, "civ")) == [("A", 8, 4, 50.0)]
    assert rows(choices(view, "map")) == [("arena",), ("islands",)]


def test_last_updated(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 7, 21, 5),), (datetime(2024, 1, 7, 9, 5),)], "ldts timestamp"
    )
    assert last_updated(df).first()[0] == "2024-01-07, 09:05 PM"


# ---- silver ----------------------------------------------------------------
def test_players_without_profile_are_left_out(spark):
    bronze = spark.createDataFrame(
        [("aztecs the great", 1, 5.9, 10, 5, 7, 1, True, "S", date(2024, 1, 7)),
         ("celts", 1, 0.0, 10, 5, None, 2, False, "S", date(2024, 1, 7))],
        "civ string, game_id bigint, match_rating_diff double, new_rating bigint, "
        "old_rating bigint, profile_id bigint, team bigint, winner boolean, source string, "
        "file_date date",
    )
    out = silver.typed_players(bronze)
    assert out.columns == [f.name for f in schemas.struct(schemas.PLAYERS)]
    assert rows(out.select("civ_name", "match_rating_diff", "team", "profile_id")) == [
        ("Aztecs The Great", 5, "1", 7)
    ]


def test_bucket_is_null_safe(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "r double")
    assert rows(df.select(elo_bucket("r"))) == [("1801 or more",), ("unknown",)]
