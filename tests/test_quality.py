from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from ladderlake import schemas
from ladderlake.quality import records
from ladderlake.quality.records import Field
from ladderlake.quality.rules import (
    HasColumns,
    InRange,
    NonEmpty,
    NotNull,
    QualityError,
    Unique,
    enforce,
    key_gate,
    quality_report,
)


@pytest.fixture
def games(spark):
    data = [(1, date(2024, 1, 1)), (2, None), (2, date(2030, 1, 1)), (None, date(2020, 1, 1))]
    return spark.createDataFrame(data, "id int, day date")


def verdicts(df, *rules):
    return {(r["rule"], r["target"]): r["violations"] for r in quality_report(df, rules).collect()}


def test_each_rule(games):
    assert verdicts(
        games,
        NotNull("id"),
        Unique(("id",)),
        InRange("day", "2021-01-01", "2026-01-01"),
        HasColumns(("id", "day")),
        NonEmpty(),
    ) == {
        ("not_null", "id"): 1,
        ("unique", "id"): 1,
        ("in_range", "day"): 2,
        ("has_columns", "id,day"): 0,
        ("non_empty", "*"): 0,
    }


def test_null_is_one_value_of_a_key(spark):
    once = spark.createDataFrame([(None, 1), (2, 1)], "a int, b int")
    twice = spark.createDataFrame([(None, 1), (None, 1)], "a int, b int")
    assert verdicts(once, Unique(("a", "b"))) == {("unique", "a,b"): 0}
    assert verdicts(twice, Unique(("a", "b"))) == {("unique", "a,b"): 1}


def test_column_order_matters(games):
    assert verdicts(games, HasColumns(("day", "id"))) == {("has_columns", "day,id"): 1}


def test_empty_table(games):
    assert verdicts(games.filter("id > 9"), *key_gate("id")) == {
        ("not_null", "id"): 0, ("unique", "id"): 0, ("non_empty", "*"): 1
    }


def test_gate_raises_with_its_failures(games):
    with pytest.raises(QualityError) as failed:
        enforce(games, key_gate("id"))
    assert [f["rule"] for f in failed.value.failures] == ["not_null", "unique"]
    enforce(games.filter("id = 1"), key_gate("id", InRange("day", "2021-01-01", "2026-01-01")))


def test_all_rules_share_one_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    gate = key_gate("o_orderkey", InRange("o_orderdate", "1990-01-01", "2010-01-01"))
    text = plan(quality_report(orders, gate))
    assert text.count("FileScan parquet") == 1
    assert "o_totalprice" not in text


# ---- records ---------------------------------------------------------------
PAIR = (Field("id", "int"), Field("name", "text"))


def judged(spark, kind, value, type_name, required=True):
    df = spark.createDataFrame([(value,)], f"v {type_name}")
    row = records.judge(df, [Field("v", kind, required)]).first()
    return row["v"], list(row["errors"])


def test_valid_rows_pass(spark):
    df = spark.createDataFrame([(1, "test1"), (2, "test2")], "id int, name string")
    assert rows(records.accepted(records.judge(df, PAIR))) == [(1, "test1"), (2, "test2")]


def test_invalid_rows_are_kept_apart_with_reasons(spark):
    df = spark.createDataFrame([("x", "a"), ("2", None), ("3", "c")], "id string, name string")
    out = records.judge(df, PAIR)
    assert rows(records.accepted(out)) == [(3, "c")]
    reasons = {tuple(r["errors"]) for r in records.quarantined(out).collect()}
    assert reasons == {("id: not a valid int",), ("name: missing",)}


@pytest.mark.parametrize(
    "kind, value, type_name, expected",
    [
        ("int", 1.0, "double", 1),
        ("int", "1", "string", 1),
        ("int", "1.0", "string", 1),
        ("int", "-12", "string", -12),
        ("int", True, "boolean", 1),
        ("int", "9007199254740993", "string", 9007199254740993),
        ("float", 3, "int", 3.0),
        ("float", "2.5", "string", 2.5),
        ("bool", "Yes", "string", True),
        ("bool", "off", "string", False),
        ("bool", 1.0, "double", True),
        ("bool", 0, "int", False),
        ("date", "2024-01-07", "string", date(2024, 1, 7)),
        ("instant", "2024-01-07 01:02:03", "string", datetime(2024, 1, 7, 1, 2, 3)),
        ("instant", 1704589323, "bigint", datetime(2024, 1, 7, 1, 2, 3)),
        ("instant", 1704589323000, "bigint", datetime(2024, 1, 7, 1, 2, 3)),
        ("instant", "1704589323", "string", datetime(2024, 1, 7, 1, 2, 3)),
        ("instant", "1704589323000", "string", datetime(2024, 1, 7, 1, 2, 3)),
        ("float", " 1e3 ", "string", 1000.0),
        ("float", "-.5", "string", -0.5),
        ("nanos", 5_000_000_000, "bigint", 5_000_000_000),
    ],
)
def test_accepted_values(spark, kind, value, type_name, expected):
    assert judged(spark, kind, value, type_name) == (expected, [])


@pytest.mark.parametrize(
    "kind, value, type_name",
    [
        ("int", 1.5, "double"),
        ("int", float("nan"), "double"),
        ("int", "1.5", "string"),
        ("int", "x", "string"),
        ("int", "", "string"),
        ("int", "99999999999999999999", "string"),
        ("float", "n/a", "string"),
        ("float", "1.5d", "string"),
        ("float", "2f", "string"),
        ("text", 5, "int"),
        ("bool", "maybe", "string"),
        ("bool", 2, "int"),
        ("date", "2024-13-01", "string"),
    ],
)
def test_rejected_values(spark, kind, value, type_name):
    assert judged(spark, kind, value, type_name) == (None, [f"v: not a valid {kind}"])


def test_missing_values(spark):
    assert judged(spark, "int", None, "int") == (None, ["v: missing"])
    assert judged(spark, "int", None, "int", required=False) == (None, [])
    absent = records.judge(spark.range(1), [Field("v", "int"), Field("w", "int", False)])
    assert list(absent.first()["errors"]) == ["v: missing"]


def test_player_profiles(spark):
    wrong = ["profile_id: not a valid int"]
    raw = [("7.0", []), ("NaN", wrong), (None, []), ("abc", wrong)]
    df = spark.createDataFrame([(v,) for v, _ in raw], "profile_id string")
    field = [f for f in records.PLAYER_RECORD if f.name == "profile_id"]
    got = [(r[0], list(r[1])) for r in records.judge(df, field).collect()]
    assert got == [(7 if v == "7.0" else None, errors) for v, errors in raw]
    # A float column says "not a number" where there is no identifier.
    floats = spark.createDataFrame([(7.9,), (float("nan"),), (None,)], "profile_id double")
    got = [(r[0], list(r[1])) for r in records.judge(floats, field).collect()]
    assert got == [(7, []), (None, []), (None, [])]


def page(spark, text):
    df = records.parse_documents(
        spark.createDataFrame([(text,)], "body string"), "body", schemas.RAW_LEADERBOARD_PAGE
    )
    out = records.judge_documents(df, schemas.RAW_LEADERBOARD_PAGE, records.PAGE_REQUIRED)
    return list(out.first()["errors"])


MEMBER = '{"profile_id": 1, "alias": "a", "country": "se"}'
STAT = '{"statgroup_id": 1, "rank": 1, "lastmatchdate": 1704589323}'


@pytest.mark.parametrize(
    "text, errors",
    [
        (f'{{"statGroups": [{{"id": 1, "members": [{MEMBER}]}}], "leaderboardStats": [{STAT}]}}', []),
        ('{"statGroups": [], "leaderboardStats": []}', []),
        ('{"statGroups": []}', ["leaderboardStats: missing"]),
        (
            f'{{"statGroups": [{{"id": 1, "members": [{MEMBER}, {{"alias": "b"}}]}}], '
            f'"leaderboardStats": [{STAT}]}}',
            ["statGroups.members.country: missing"],
        ),
        (
            '{"statGroups": [{"id": 1}], "leaderboardStats": [{"statgroup_id": 1, "rank": 2}]}',
            ["statGroups.members: missing", "leaderboardStats.lastmatchdate: missing"],
        ),
    ],
)
def test_documents(spark, text, errors):
    assert page(spark, text) == errors


def test_numbers_of_documents_are_taken_however_they_are_written(spark):
    member = '{"profile_id": 12.5, "alias": "a", "country": "se", "xp": "3.0"}'
    text = f'{{"statGroups": [{{"id": "5", "members": [{member}]}}], "leaderboardStats": [{STAT}]}}'
    df = spark.createDataFrame([(text,)], "body string")
    doc = records.parse_documents(df, "body", schemas.RAW_LEADERBOARD_PAGE)
    assert doc.select("doc.*").drop(records.CORRUPT).schema == schemas.struct(schemas.RAW_LEADERBOARD_PAGE)
    first = doc.select(F.col("doc.statGroups")[0].alias("g")).first()["g"]
    assert (first.id, first.members[0].profile_id, first.members[0].xp) == (5, 12, 3)
    assert page(spark, text) == []
    assert page(spark, text.replace('"5"', '"5.5"'))[0] == "document: malformed or mistyped"


def test_mistyped_and_malformed_documents(spark):
    wrong = '{"statGroups": [{"id": "x", "members": []}], "leaderboardStats": []}'
    assert page(spark, wrong)[0] == "document: malformed or mistyped"
    assert page(spark, "{not json")[0] == "document: malformed or mistyped"


def test_empty_dump_is_flagged(spark):
    text = (
        '{"db_dumps": [{"start_date": "2024-01-07", "num_matches": 0, "matches_url": "m", '
        '"players_url": "p"}, {"start_date": "2024-01-14", "num_matches": 3, '
        '"matches_url": "m", "players_url": "p"}]}'
    )
    manifest = spark.createDataFrame([(text,)], "body string").select(
        F.from_json("body", schemas.struct(schemas.RAW_MANIFEST)).alias("m")
    )
    out = records.manifest_entries(manifest.select("m.*")).select("start_date", "warning")
    assert rows(out) == [
        (date(2024, 1, 14), None),
        (date(2024, 1, 7), "File 2024-01-07 is present but is empty!"),
    ]


def test_gate_of_sound_keys_counts_hashes_only(spark, monkeypatch):
    from ladderlake.quality import rules

    def exact(*_):
        raise AssertionError("the exact report is for keys that the hashes cast doubt on")

    monkeypatch.setattr(rules, "quality_report", exact)
    good = spark.createDataFrame([("a", 1), ("b", 1)], "id string, n int")
    enforce(good, key_gate("id"))
    with pytest.raises(AssertionError):
        enforce(good, key_gate("n"))
