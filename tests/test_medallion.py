"""The whole run on a few small files, twice."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import rows
from ladderlake import schemas
from ladderlake.plans import medallion, views
from ladderlake.quality.rules import QualityError
from ladderlake.sinks.workspace import fresh_path
from ladderlake.sources import scans

SUNDAYS = [date(2024, 1, 7), date(2024, 1, 14), date(2024, 1, 21)]
CIVS = ["aztecs", "britons", "celts"]


def write_files(root, late=()):
    """Three weeks of matches with two players each; `late` ids come with the last week."""
    (root / "matches").mkdir(exist_ok=True)
    (root / "players").mkdir(exist_ok=True)
    (root / "pages").mkdir(exist_ok=True)
    for week, sunday in enumerate(SUNDAYS):
        ids = [10 * week + i for i in range(6)] + (list(late) if week == 2 else [])
        n = len(ids)
        start = [datetime.combine(sunday, datetime.min.time()) - timedelta(days=i % 6 + 1) for i in range(n)]
        matches = {
            "avg_elo": [500.0 + 100 * i for i in range(n)],
            "duration": pa.array([(600 + i) * 10**9 for i in range(n)], pa.int64()),
            "game_id": ids,
            "game_speed": ["normal"] * n,
            "game_type": ["random"] * n,
            "irl_duration": pa.array([(300 + i) * 10**9 for i in range(n)], pa.int64()),
            "leaderboard": ["random_map" if i != 5 else "empire_wars" for i in range(n)],
            "map": ["arena" if i % 2 else "islands" for i in range(n)],
            "mirror": [False] * n,
            "num_players": [2] * n,
            "patch": [101] * n,
            "raw_match_type": pa.array([6.0] * n, pa.float64()),
            "replay_enhanced": [True] * n,
            "started_timestamp": pa.array(start, pa.timestamp("ns")),
            "starting_age": ["dark"] * n,
            "team_0_elo": [500.5] * n,
            "team_1_elo": [499.5] * n,
        }
        pq.write_table(pa.table(matches), root / "matches" / f"{sunday}.parquet")
        players = [
            {
                "civ": CIVS[(game + side) % 3], "game_id": game, "match_rating_diff": 3.0,
                "new_rating": 1000 + side, "old_rating": 990, "profile_id": 100 + side,
                "replay_summary_raw": None, "team": side, "winner": side == game % 2,
            }
            for game in ids for side in (0, 1)
        ]
        table = pa.Table.from_pylist(players).cast(
            pa.schema([
                ("civ", pa.string()), ("game_id", pa.int64()), ("match_rating_diff", pa.float64()),
                ("new_rating", pa.int64()), ("old_rating", pa.int64()), ("profile_id", pa.int64()),
                ("replay_summary_raw", pa.string()), ("team", pa.int64()), ("winner", pa.bool_()),
            ])
        )
        pq.write_table(table, root / "players" / f"{sunday}.parquet")
    for side in (0, 1):
        document = {
            "statGroups": [{
                "id": side, "name": "", "type": 1,
                "members": [{
                    "profile_id": 100 + side, "alias": f"player {side}", "country": ["se", "xx"][side],
                    "personal_statgroup_id": side, "xp": 0, "level": 1, "leaderboardregion_id": 0,
                }],
            }],
            "leaderboardStats": [{
                "statgroup_id": side, "leaderboard_id": 3, "wins": 3 * side, "losses": side,
                "rank": 2 - side, "rating": 1000, "lastmatchdate": 1704589323,
            }],
        }
        (root / "pages" / f"page_{side}.json").write_text(json.dumps(document, indent=4))
    (root / "countries.csv").write_text("Country,Country_code\nSweden,se\n")


def raw_files(root):
    return medallion.RawFiles(
        scans.weekly_parquet(f"{root}/matches", "FEED", nanos=("started_timestamp",)),
        scans.weekly_parquet(f"{root}/players", "FEED"),
        scans.json_documents(f"{root}/pages", "BOARD", schemas.RAW_LEADERBOARD_PAGE),
        scans.csv_lookup(f"{root}/countries.csv", "LOOKUP", schemas.RAW_COUNTRIES),
    )


@pytest.fixture
def lake(spark, request):
    tag = f"{request.node.name}_{abs(hash(request.node.nodeid)) % 10**6}"
    made = medallion.Lake(fresh_path(spark, "exports"), f"br_{tag}", f"sr_{tag}", f"gd_{tag}")
    made.create(spark, fresh_path(spark, "lake"))
    spark.conf.set(scans.NANOS_AS_LONG, "true")
    yield made
    spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")


def test_run_twice_with_a_late_match(spark, tmp_path, lake):
    write_files(tmp_path)
    run = lambda window: medallion.run(spark, raw_files(tmp_path), lake, window)
    run((SUNDAYS[0], SUNDAYS[1]))
    fact = f"{lake.gold}.fact_player_matches_gd"
    assert spark.table(fact).count() == 20  # two weeks, five ranked matches, two players
    first = rows(spark.table(fact))

    run((SUNDAYS[0], SUNDAYS[1]))
    assert rows(spark.table(fact)) == first

    # The next window overlaps the first by a week and brings a new week with a late match.
    write_files(tmp_path, late=[90])
    run((SUNDAYS[1], SUNDAYS[2]))
    assert spark.table(fact).count() == 32
    assert spark.table(f"{lake.gold}.dim_match_gd").count() == 16
    assert rows(spark.table(f"{lake.gold}.dim_civ_gd").select("civ_name")) == [
        ("Aztecs",), ("Britons",), ("Celts",)
    ]
    assert spark.table(f"{lake.gold}.dim_date_gd").count() == 3653
    assert rows(
        spark.table(f"{lake.gold}.dim_player_gd").select("gaming_name", "country_name")
    ) == [("player 0", "Sweden"), ("player 1", "Unknown")]

    exported = scans.scan_export(
        spark, f"{lake.exports}/vw_opponent_civ_analysis", schemas.VIEW_OPPONENT_CIV
    )
    assert rows(exported.select("civ", "matches_played").groupBy("civ").sum()) and (
        exported.agg({"matches_played": "sum"}).first()[0] == 32
    )
    board = scans.scan_export(
        spark, f"{lake.exports}/vw_leaderboard_analysis", schemas.VIEW_LEADERBOARD
    )
    assert [(r["player_name"], r["win_percentage"]) for r in board.collect()] == [
        ("player 1", 75.0), ("player 0", None)
    ]
    fact_view = views.civ_performance(
        spark.table(fact), spark.table(f"{lake.gold}.dim_match_gd"),
        spark.table(f"{lake.gold}.dim_civ_gd"),
    )
    assert fact_view.agg({"wins": "sum"}).first()[0] == 16


def test_arrivals_are_validated_first(spark, tmp_path, lake):
    """A page cut off and a player without civ go to quarantine, once however often they come."""
    write_files(tmp_path)
    (tmp_path / "pages" / "page_9.json").write_text('{"statGroups": [')
    sunday = tmp_path / "players" / f"{SUNDAYS[0]}.parquet"
    table = pq.read_table(sunday)
    bad = table.slice(0, 1).set_column(0, "civ", pa.array([None], pa.string()))
    pq.write_table(pa.concat_tables([table, bad]), sunday)
    landing = replace(lake, landing=fresh_path(spark, "landing"))
    window = (SUNDAYS[0], SUNDAYS[1])
    medallion.run(spark, raw_files(tmp_path), landing, window)
    assert spark.table(f"{lake.gold}.fact_player_matches_gd").count() == 20
    for _ in range(2):
        quarantine = f"{landing.landing}/quarantine"
        assert rows(spark.read.parquet(f"{quarantine}/players").select("errors")) == [
            (["civ: missing"],)
        ]
        assert rows(spark.read.parquet(f"{quarantine}/leaderboard_pages").select("value")) == [
            ('{"statGroups": [',)
        ]
        medallion.land(spark, raw_files(tmp_path), landing.landing, window)
    assert spark.table(f"{lake.gold}.dim_player_gd").count() == 2


def test_a_failing_gate_keeps_the_table(spark, tmp_path, lake):
    write_files(tmp_path)
    with pytest.raises(QualityError, match="in_range"):
        medallion.run(
            spark, raw_files(tmp_path), lake, (SUNDAYS[0], SUNDAYS[2]),
            game_dates=("2030-01-01", "2031-01-01"),
        )
    assert not spark.catalog.tableExists(f"{lake.silver}.matches_s2r")
