from __future__ import annotations

import hashlib
from datetime import date, datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import plan, rows
from ladderlake.functions import cleaning
from ladderlake.functions import columns as c
from ladderlake.sinks.files import land_nanos
from ladderlake.sources import scans


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "rating, label",
    [
        (0, "600 or less"), (600, "600 or less"), (600.01, "600-800"), (800, "600-800"),
        (1000, "800-1000"), (1200, "1000-1200"), (1400, "1200-1400"), (1600, "1400-1600"),
        (1800, "1600-1800"), (1800.01, "1801 or more"), (None, "unknown"),
    ],
)
def test_elo_bucket_edges(spark, rating, label):
    assert value(spark, c.elo_bucket(F.lit(rating).cast("decimal(38,2)"))) == label


def test_keys(spark):
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert value(spark, c.composite_key(F.lit(7), F.lit("FEED"))) == md5("7~FEED")
    # A null part is skipped: the key is never null.
    assert value(spark, c.composite_key(F.lit(None), F.lit("FEED"))) == md5("FEED")
    assert value(spark, c.single_key(F.lit(None))) is None
    assert value(spark, c.date_key(F.lit("2024-01-07").cast("date"))) == 20240107


def test_percentages(spark):
    assert value(spark, c.percentage(F.lit(1), F.lit(8))) == 12.5
    assert value(spark, c.percentage(F.lit(0), F.lit(0))) == 0.0
    assert value(spark, c.percentage_or_null(F.lit(0), F.lit(0))) is None
    # More players of a civ may win than matches were played: that is the measure.
    assert value(spark, c.percentage(F.lit(3), F.lit(1))) == 300.0


def test_time(spark):
    assert value(spark, c.nanos_to_secs(F.lit(1_999_999_999))) == 1
    assert value(spark, c.nanos_to_secs(F.lit(-1_999_999_999))) == -1
    assert value(spark, c.week_start(F.lit("2024-01-07").cast("date"))) == date(2024, 1, 1)
    assert value(spark, c.file_date_of(F.lit("2024-01-07.parquet"))) == date(2024, 1, 7)
    assert value(spark, c.file_date_of(F.lit("manifest.json"))) is None


def test_conform(spark):
    df = spark.createDataFrame([("7", 1.9, "x")], "a string, b double, extra string")
    assert rows(c.conform(df, "b int, a bigint")) == [(1, 7)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="extra is no int: "):
                c.conform(df, "extra int").collect()
            narrow = spark.createDataFrame([(1 << 40,)], "n bigint")
            with pytest.raises(Exception, match="n is no int: 1099511627776"):
                c.conform(narrow, "n int").collect()
            assert rows(c.conform(narrow, "n decimal(38,2)"))[0][0] == 1 << 40
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        c.conform(df, "missing int")


def test_nanosecond_parquet(spark, tmp_path):
    """Files with nanosecond timestamps, which Spark reads as plain counts."""
    before = datetime(1969, 12, 31, 23, 59, 59, 999_999)
    stamps = [datetime(2024, 1, 7, 12, 30, 1, 5), before, None]
    table = pa.table({"t": pa.array(stamps, pa.timestamp("ns")), "id": [1, 2, 3]})
    pq.write_table(table, tmp_path / "2024-01-07.parquet")
    with pytest.raises(ValueError, match="nanosecond"):
        scans.scan(spark, scans.weekly_parquet(str(tmp_path), "FEED", nanos=("t",)))
    spark.conf.set(scans.NANOS_AS_LONG, "true")
    try:
        df = scans.scan(spark, scans.weekly_parquet(str(tmp_path), "FEED", nanos=("t",)))
        got = df.select("id", F.col("t").cast("timestamp_ntz"))
        assert rows(got) == [(1, stamps[0]), (2, before), (3, None)]
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")


def test_provenance(spark, tmp_path):
    """Dated files, equal rows within a file, and a window that keeps its ends."""
    for day in ("2024-01-07", "2024-01-14", "2024-01-21"):
        pq.write_table(pa.table({"k": [1, 1, 2]}), tmp_path / f"{day}.parquet")
    df = scans.scan(spark, scans.weekly_parquet(str(tmp_path), "FEED"))
    out = scans.with_provenance(df, "FEED", dated=True, window=("2024-01-07", "2024-01-14"))
    assert out.columns == ["k", "fn", "file_date", "source", "ldts"]
    assert rows(out.select("k", "fn", "file_date", "source")) == [
        (1, "2024-01-07.parquet", date(2024, 1, 7), "FEED"),
        (1, "2024-01-14.parquet", date(2024, 1, 14), "FEED"),
        (2, "2024-01-07.parquet", date(2024, 1, 7), "FEED"),
        (2, "2024-01-14.parquet", date(2024, 1, 14), "FEED"),
    ]


def test_provenance_keeps_folders_apart(spark, tmp_path):
    """Equal rows in files of one name, in folders whose names are escaped in paths."""
    for folder in ("a", "b c+d%"):
        (tmp_path / folder).mkdir()
        pq.write_table(pa.table({"k": [1, 1]}), tmp_path / folder / "2024-01-07.parquet")
    source = scans.FileSource(str(tmp_path), "parquet", "FEED", options={"recursiveFileLookup": "true"})
    out = scans.with_provenance(
        scans.scan(spark, source), "FEED", dated=True, root=source.path
    )
    assert rows(out.select("k", "fn", "file_date")) == [
        (1, "a/2024-01-07.parquet", date(2024, 1, 7)),
        (1, "b c+d%/2024-01-07.parquet", date(2024, 1, 7)),
    ]


LINE = "k int, more array<struct<x: string>>"


def test_json_documents(spark, tmp_path):
    """One document or one array per file; a second document is an error, not a loss."""
    (tmp_path / "a.json").write_text('{\n "k": 1,\n "more": [{"x": "]"}]\n}\n')
    (tmp_path / "b.json").write_text('\n[ {"k": 2}, {"k": 3, "more": []}\n]\n')
    source = scans.json_documents(str(tmp_path), "FEED", LINE)
    df = scans.scan(spark, source)
    assert rows(df.select("k", "more")) == [(1, [Row(x="]")]), (2, None), (3, [])]
    named = scans.with_provenance(df, "FEED", root=source.path)
    assert rows(named.select("k", "fn")) == [(1, "a.json"), (2, "b.json"), (3, "b.json")]
    for bad in ('{"k": 1}\n{"k": 2}', '{"k": 1', '{"k": "x"}', '[{"k": 1}] [{"k": 2}]'):
        (tmp_path / "c.json").write_text(bad)
        with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|malformed"):
            scans.scan(spark, source).collect()


def test_malformed_lines_fail(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}\n{"k": 2, "mo\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        scans.scan(spark, scans.json_lines(str(tmp_path / "a.json"), "FEED", LINE)).collect()
    (tmp_path / "a.csv").write_text("a,b\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        scans.scan(spark, scans.csv_lookup(str(tmp_path / "a.csv"), "FEED", "a string, b string")).collect()


def test_cleaning(spark):
    assert value(spark, cleaning.float_id(F.lit("123.0"))) == 123
    assert value(spark, cleaning.float_id(F.lit("NaN"))) is None
    assert value(spark, cleaning.float_id(F.lit(float("nan")))) is None
    assert value(spark, cleaning.to_text(F.lit(None).cast("int"))) is None
    assert value(spark, cleaning.to_float(F.lit("n/a"))) is None


def test_recast_keeps_columns_that_do_not_fit(spark):
    df = spark.createDataFrame([("1", "x"), (None, "2")], "a string, b string")
    casts = {"a": "bigint", "b": "bigint", "absent": "int"}
    assert rows(cleaning.cast_failures(df, casts)) == [
        ("a", "bigint", True, 0), ("absent", "int", False, None), ("b", "bigint", True, 1)
    ]
    assert cleaning.recast(df, casts).dtypes == [("a", "bigint"), ("b", "string")]


def test_files_of_both_units_in_one_folder(spark, tmp_path):
    """Nanosecond files of a data frame library, microseconds and legacy stamps of Spark, and
    plain counts; each is read by its own footer."""
    at = datetime(2024, 1, 7, 12, 30, 1, 234567)
    one = spark.createDataFrame([(1, at)], "k int, t timestamp")
    path = str(tmp_path / "feed")
    land_nanos(one, f"{path}/file_date=2024-01-07", "t")
    for day, kind in ((14, "TIMESTAMP_MICROS"), (21, "INT96")):
        spark.conf.set("spark.sql.parquet.outputTimestampType", kind)
        one.write.parquet(f"{path}/file_date=2024-01-{day}")
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    counts = one.withColumn("t", F.unix_micros("t") * 1000)
    counts.write.parquet(f"{path}/file_date=2024-01-28")
    footer = next(Path(path, "file_date=2024-01-07").glob("*.parquet"))
    assert pq.read_schema(footer).field("t").type == pa.timestamp("ns", "UTC")
    spark.conf.set(scans.NANOS_AS_LONG, "true")
    try:
        feed = scans.weekly_parquet(path, "FEED", nanos=("t",), mixed=True)
        found = scans.with_provenance(scans.scan(spark, feed), "FEED", dated=True, root=path)
        got = rows(found.select("k", F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.dayofmonth("file_date")))
        window = scans.with_provenance(
            scans.scan(spark, feed), "FEED", dated=True, root=path, window=("2024-01-20", "2024-01-29")
        )
        assert window.count() == 2
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
    assert got == [(1, "2024-01-07 12:30:01.234567", day) for day in (14, 21, 28, 7)]


def test_packed_text_gives_back_every_text(spark):
    texts = ["", "0", "ab", "AB", "aB", "00ff", "a" * 32, "01" * 16, "xyz", "d41d8cd98f00b204e9800998ecf8427e", "é", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    packed = df.select("i", "t", c.packed_text("t").alias("p"))
    found = packed.select("t", c.unpacked_text("p"), F.octet_length("p")).orderBy("i").collect()
    assert [r[1] for r in found] == texts == [r[0] for r in found]
    assert [r[2] for r in found if r[0] and len(r[0]) == 32] == [17] * 3
    assert packed.where("p is not null").select("p").distinct().count() == len(texts) - 1


def test_rows_are_made_distinct_behind_their_shuffle_only(spark, tmp_path):
    """Combined before it, most rows of a file would be in one task's memory."""
    path = str(tmp_path / "dated")
    spark.range(20).selectExpr("id % 5 AS n", "DATE '2024-01-07' AS file_date").write.partitionBy("file_date").parquet(path)
    out = scans.with_provenance(spark.read.parquet(path).drop("fn"), "FEED", dated=True, root=path)
    above, below = plan(out).split("Exchange hashpartitioning")
    assert "HashAggregate" in above and "Aggregate" not in below
    files = out.select("fn").distinct().count()
    assert out.count() == out.select("n", "fn").distinct().count() and files >= 1
