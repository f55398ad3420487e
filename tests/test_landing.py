from __future__ import annotations

import json
from datetime import date
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from ladderlake import schemas
from ladderlake.plans.landing import land_documents, land_records
from ladderlake.quality.records import PAGE_REQUIRED, Field
from ladderlake.sinks import ledger
from ladderlake.sinks.ledger import current_rejects
from ladderlake.sources import scans
from ladderlake.sources.documents import Splitter, document_pages
from test_quality import MEMBER, STAT

D1, D2 = date(2024, 1, 7), date(2024, 1, 14)
FIELDS = (Field("id", "int"), Field("name", "text"))


def test_records(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    layout = "id string, name string, file_date date"
    first = spark.createDataFrame([("1", "a", D1), ("x", "b", D1), ("2", "c", D2)], layout)
    land_records(first, FIELDS, good, bad, casts={"id": "int", "name": "double"})
    landed = spark.read.parquet(good)
    assert dict(landed.dtypes)["id"] == "int" and dict(landed.dtypes)["name"] == "string"
    assert rows(landed.select("id", "name", "file_date")) == [(1, "a", D1), (2, "c", D2)]
    assert rows(spark.read.parquet(bad).select("name", "errors")) == [
        ("b", ["id: not a valid int"])
    ]
    # The same delivery again changes nothing.
    land_records(first, FIELDS, good, bad, casts={"id": "int", "name": "double"})
    assert spark.read.parquet(good).count() == 2 and spark.read.parquet(bad).count() == 1
    # A delivery without one valid record leaves what has landed.
    land_records(spark.createDataFrame([("y", "d", D2)], layout), FIELDS, good, bad)
    assert spark.read.parquet(good).count() == 2
    assert rows(spark.read.parquet(bad).select("name")) == [("b",), ("d",)]


def test_documents(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    valid = f'{{"statGroups": [{{"id": 1, "members": [{MEMBER}]}}], "leaderboardStats": [{STAT}]}}'
    docs = spark.createDataFrame([(valid,)] * 6 + [('{"statGroups": []}',)], "body string")
    docs = docs.coalesce(1)
    land_documents(docs, "body", schemas.RAW_LEADERBOARD_PAGE, PAGE_REQUIRED, good, bad)
    # All six are in one file, and the scan of the bronze job reads all six.
    back = scans.scan(spark, scans.json_lines(good, "BOARD", schemas.RAW_LEADERBOARD_PAGE))
    assert rows(back.selectExpr("statGroups[0].members[0].alias", "leaderboardStats[0].rank")) == [
        ("a", 1)
    ] * 6
    for _ in range(2):
        assert rows(current_rejects(spark, bad, "delivery")) == [
            ('{"statGroups": []}', ["leaderboardStats: missing"], "latest")
        ]
        land_documents(docs, "body", schemas.RAW_LEADERBOARD_PAGE, PAGE_REQUIRED, good, bad)


# ---- quarantine by delivery ------------------------------------------------
RECORDS = "id string, name string, file_date date"


def delivered(spark, *data):
    return spark.createDataFrame(list(data), RECORDS)


def test_a_corrected_delivery_empties_the_quarantine(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    rejects = lambda: rows(current_rejects(spark, bad, "file_date").select("name", "file_date"))
    land_records(
        delivered(spark, ("1", "a", D1), ("x", "b", D1), ("y", "c", D2), ("z", "d", None)),
        FIELDS, good, bad,
    )
    assert rejects() == [("b", D1), ("c", D2), ("d", None)]
    land_records(delivered(spark, ("1", "a", D1), ("3", "b", D1)), FIELDS, good, bad)
    assert rejects() == [("c", D2), ("d", None)]
    assert rows(spark.read.parquet(good).select("id", "name")) == [(1, "a"), (3, "b")]
    land_records(delivered(spark, ("2", "c", D2), ("4", "d", None)), FIELDS, good, bad)
    assert rejects() == [] and not list((tmp_path / "bad").rglob("landed=*/*.parquet"))
    assert current_rejects(spark, bad, "file_date").columns == ["id", "name", "file_date", "errors"]


def test_a_manifest_covers_dates_without_records(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    land_records(delivered(spark, ("x", "b", D1), ("y", "c", D2)), FIELDS, good, bad)
    empty = delivered(spark, ("1", "a", D1)).where("false")
    land_records(empty, FIELDS, good, bad, manifest=spark.createDataFrame([(D2,)], "file_date date"))
    assert rows(current_rejects(spark, bad, "file_date").select("name")) == [("b",)]


def test_rejects_change_at_once(spark, tmp_path, monkeypatch):
    """Broken off before the entry of the ledger, and behind it, before the old files go."""
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    rejects = lambda: rows(current_rejects(spark, bad, "file_date").select("name"))
    land_records(delivered(spark, ("x", "old", D1), ("y", "other", D2)), FIELDS, good, bad)
    again = delivered(spark, ("z", "new", D1))

    def lost(*_):
        raise RuntimeError("driver lost")

    for step, seen in (("rename", "old"), ("discard", "new")):
        with monkeypatch.context() as broken, pytest.raises(RuntimeError):
            broken.setattr(ledger, step, lost)
            land_records(again, FIELDS, good, bad)
        assert rejects() == [(seen,), ("other",)]
    land_records(again, FIELDS, good, bad)
    assert rejects() == [("new",), ("other",)]
    assert len(list((tmp_path / "bad").rglob("landed=*"))) == 2


# ---- pages of array files --------------------------------------------------
def pages_of(text):
    """The pieces that a scan cuts at every opening brace."""
    first, *rest = text.split("{")
    splitter, found = Splitter(), []
    for piece in (first, *("{" + r for r in rest)):
        found += splitter.feed(piece)
    return [*found, *splitter.end()]


VALUES = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-9, 9), st.text("a{}[]\\\",: \n", max_size=6)),
    lambda v: st.one_of(
        st.lists(v, max_size=3), st.dictionaries(st.text("k{\\\"", max_size=3), v, max_size=3)
    ),
    max_leaves=8,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(VALUES, max_size=5), st.sampled_from([None, 1, 4]))
def test_arrays_come_apart_into_their_elements(values, indent):
    found = pages_of(json.dumps(values, indent=indent))
    assert [json.loads(v) for v, _ in found] == values and not any(f for _, f in found)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.text(max_size=3), VALUES, max_size=3))
def test_a_document_is_one_page(value):
    assert pages_of(json.dumps(value)) == [(json.dumps(value), None)]


def test_faults_of_places():
    assert pages_of('[{"a":1},{"b":') == [('{"a":1}', None), ('{"b":', "document: cut off")]
    assert pages_of('[{"a":1},') == [
        ('{"a":1}', None), ("", "document: the file ends inside its array")
    ]
    assert pages_of('{"a":1} {"b":2}')[1][1] == "document: behind the end of another"
    assert pages_of('[{"a":1} {"b":2}]')[1][1] == "document: not separated from the one before"
    assert pages_of('[{"a":1},,{"b":2}]')[1][1] == "document: nothing between two commas"
    assert pages_of("") == pages_of(" \n") == pages_of("[]") == []
    long = Splitter(longest=10)
    found = [*long.feed('{"a":"' + "x" * 30), *long.feed('"}'), *long.end()]
    assert "".join(v for v, _ in found) == '{"a":"' + "x" * 30 + '"}' and all(f for _, f in found)


def test_one_bad_page_of_an_array(spark, tmp_path):
    """The others land; the file is cut into many pieces and larger than any batch of them."""
    good, bad, raw = (str(tmp_path / n) for n in ("good", "bad", "raw"))
    valid = json.loads(f'{{"statGroups": [{{"id": 1, "members": [{MEMBER}]}}], "leaderboardStats": [{STAT}]}}')
    pages = [valid] * 300 + [{"statGroups": []}] + [valid] * 300
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text(json.dumps(pages, indent=2))
    (tmp_path / "raw" / "b.json").write_text(json.dumps(valid))
    (tmp_path / "raw" / "c.json").write_text(json.dumps([valid, valid])[:-9])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20KB")
    try:
        blocks = spark.read.text(raw, lineSep="{").select("_metadata.file_block_start").distinct()
        assert blocks.count() > 1
        found = document_pages(spark, raw)
        land_documents(
            found, "value", schemas.RAW_LEADERBOARD_PAGE, PAGE_REQUIRED, good, bad, fault="fault"
        )
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    back = scans.scan(spark, scans.json_lines(good, "BOARD", schemas.RAW_LEADERBOARD_PAGE))
    assert back.count() == 602
    assert rows(current_rejects(spark, bad, "delivery").select("errors")) == [
        (["document: cut off"],), (["leaderboardStats: missing"],)
    ]


def test_page_files_lie_in_one_folder(spark, sf, monkeypatch):
    """A folder per file is a listing per file, and they were all written by one task."""
    from ladderlake.registry import quality_queries
    from ladderlake.sinks import workspace

    paths = {}

    def noted(spark, name):
        return paths.setdefault(name, workspace.fresh_path(spark, name))

    monkeypatch.setattr(quality_queries, "fresh_path", noted)
    quality_queries.land_array_files(spark, sf)
    raw = Path(paths["array_files"])
    assert not [f for f in raw.iterdir() if f.is_dir()]
    assert len({f.name.split("-")[1] for f in raw.glob("part-*")}) > 1
