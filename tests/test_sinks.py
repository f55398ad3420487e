from __future__ import annotations

import gzip
from datetime import date, datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from ladderlake import schemas
from ladderlake.operators.filters import in_run_window
from ladderlake.sinks import commits, key_index, tables
from ladderlake.sinks.commits import ConcurrentMerge
from ladderlake.sinks.files import export_csv_gz, land_parquet
from ladderlake.sinks.tables import DuplicateKeys, Merged, sweep, upsert, write_table
from ladderlake.sinks.workspace import fresh_path, shared_root, stage
from ladderlake.sources import scans

D1, D2, D3, D4 = (date(2024, 1, d) for d in (7, 14, 21, 28))
LAYOUT = "id int, v string, file_date date"


def frame(spark, *data):
    return spark.createDataFrame(list(data), LAYOUT)


@pytest.fixture(params=[None, "file_date"], ids=["whole", "partitioned"])
def part(request):
    return request.param


def test_upsert_creates_updates_and_inserts(spark, database, part):
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D1), (3, "c", D2)), name, "id", part)
    incoming = frame(spark, (2, "B", D1), (4, "d", D2), (5, "e", D3))
    upsert(spark, incoming, name, "id", part)
    expected = [(1, "a", D1), (2, "B", D1), (3, "c", D2), (4, "d", D2), (5, "e", D3)]
    assert rows(spark.table(name).select("id", "v", "file_date")) == expected
    # The same load again changes nothing.
    upsert(spark, incoming, name, "id", part)
    assert rows(spark.table(name).select("id", "v", "file_date")) == expected


def test_rows_move_between_partitions(spark, database, part):
    """The only row of a partition moves away; the partition ends up empty, not doubled."""
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D2)), name, "id", part)
    upsert(spark, frame(spark, (1, "A", D3)), name, "id", part)
    assert rows(spark.table(name).select("id", "v", "file_date")) == [(1, "A", D3), (2, "b", D2)]
    upsert(spark, frame(spark, (3, "c", D1)), name, "id", part)
    assert spark.table(name).count() == 3


@pytest.mark.parametrize("step", [0, 1, 2, 4, 5])
def test_a_merge_that_broke_off_loses_nothing_and_is_completed_by_the_next(
    spark, database, monkeypatch, step
):
    """Broken off before and between the switches, before the drop, before the deletion."""
    name = f"{database}.t"
    held = frame(spark, (1, "a", D1), (2, "b", D2), (4, "d", D2), (5, "e", D1), (6, "f", D4))
    upsert(spark, held, name, "id", "file_date")
    moved = frame(spark, (1, "A", D3), (3, "c", D2), (5, "E", D3), (6, "F", D2))
    calls = []

    def breaks(real):
        def call(*given):
            calls.append(given)
            if len(calls) > step:
                raise RuntimeError("driver lost")
            return real(*given)

        return call

    with monkeypatch.context() as broken:
        for part in ("_add", "_point", "_spec_dropped", "discard"):
            broken.setattr(tables, part, breaks(getattr(tables, part)))
        with pytest.raises(RuntimeError):
            upsert(spark, moved, name, "id", "file_date")
    spark.catalog.refreshTable(name)
    seen = rows(spark.table(name).filter(F.col("id").isin(2, 4)))
    assert seen == [(2, "b", D2), (4, "d", D2)]  # rows that the source does not replace
    upsert(spark, moved, name, "id", "file_date")
    assert rows(spark.table(name)) == [
        (1, "A", D3), (2, "b", D2), (3, "c", D2), (4, "d", D2), (5, "E", D3), (6, "F", D2)
    ]


def test_names_that_paths_escape(spark, tmp_path):
    """A space in the table's folder; spaces, signs and quotes in partition values."""
    database = f"odd_{tmp_path.name}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/a folder'")
    name = f"{database}.t"
    layout = "id int, v string, place string"
    odd = ["a b", "50%", "x=y/z", "it's", "back\\slash", "é", "a+b", "", None]
    held = [(i, "old", p) for i, p in enumerate(odd)]
    upsert(spark, spark.createDataFrame(held, layout), name, "id", "place")
    new = [(i, "new", odd[i - 1]) for i in range(len(odd))]
    for _ in range(2):
        upsert(spark, spark.createDataFrame(new, layout), name, "id", "place")
        got = rows(spark.table(name).select("id", "v", "place"))
        assert [(i, v, p or None) for i, v, p in got] == [(i, v, p or None) for i, v, p in new]
    files = [f for f in (tmp_path / "a folder" / "t").rglob("*.parquet")]
    live = spark.table(name).select("_metadata.file_path").distinct().count()
    assert len(files) == live  # the replaced files are gone
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_partitions_that_get_rows_are_not_searched(spark, database):
    """Several rows of one partition, some staying, some moved in from another."""
    name = f"{database}.t"
    held = [(i, "old", D1 if i % 2 else D2) for i in range(40)]
    upsert(spark, frame(spark, *held), name, "id", "file_date")
    new = [(i, "new", D2) for i in range(0, 40, 3)] + [(99, "new", None)]
    upsert(spark, frame(spark, *new), name, "id", "file_date")
    expected = {i: (i, "old", d) for i, _, d in held} | {r[0]: r for r in new}
    assert rows(spark.table(name)) == sorted(expected.values(), key=repr)


def table_files(spark, name):
    """Every data file below the table's folder, live or not."""
    where = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    root = Path(where["Location"].removeprefix("file:"))
    root = root.parent if "__v_" in root.name else root
    return {f for f in root.rglob("part-*.parquet") if f"{name.split('.')[1]}__keys" not in str(f)}


def live_files(spark, name):
    seen = spark.table(name).select("_metadata.file_path").distinct().collect()
    return {Path(r[0].removeprefix("file://").removeprefix("file:")) for r in seen}


def test_a_merge_reads_no_partition_that_it_does_not_touch(spark, database):
    """The other partitions' files are destroyed: a merge that looked into one would fail."""
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D2), (3, "c", D3)), name, "id", "file_date")
    whole = {}
    for file in table_files(spark, name):
        if f"file_date={D2}" not in str(file):
            whole[file] = file.read_bytes()
            file.write_bytes(b"")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    done = upsert(spark, frame(spark, (2, "B", D2), (4, "d", D4)), name, "id", "file_date")
    assert done == Merged(1, 1) and len(whole) == 2
    for file, data in whole.items():
        file.write_bytes(data)
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name).select("id", "v")) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_the_index_follows_rows_that_move(spark, database, monkeypatch):
    name = f"{database}.t"
    monkeypatch.setattr(key_index, "APPENDS", 3)
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D1), (None, "n", D1)), name, "id", "file_date")
    first = key_index.properties(spark, name)[key_index.INDEX]
    for step, day in enumerate((D2, D3, D1, D4)):
        upsert(spark, frame(spark, (1, str(step), day)), name, "id", "file_date")
        assert rows(spark.table(name).where("id = 1").select("v", "file_date")) == [(str(step), day)]
    last = key_index.properties(spark, name)[key_index.INDEX]
    assert last != first and not spark.catalog.tableExists(first)  # written anew once
    assert rows(spark.table(last).select("part")) == [(D4,), (D1,), (D1,)]  # by repr


def test_an_index_is_built_where_none_is_named(spark, database):
    """After an overwrite, and after rows written past the merge."""
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1)), name, "id", "file_date")
    write_table(frame(spark, (1, "a", D2), (2, "b", D3)), name, partition_by="file_date")
    upsert(spark, frame(spark, (1, "A", D1)), name, "id", "file_date")
    frame(spark, (3, "c", D4)).write.mode("append").insertInto(name)
    key_index.forget(spark, name)
    upsert(spark, frame(spark, (3, "C", D1)), name, "id", "file_date")
    assert rows(spark.table(name).select("id", "v", "file_date")) == [
        (1, "A", D1), (2, "b", D3), (3, "C", D1)
    ]


def test_a_first_load_is_written_once(spark, database, part):
    """The table's only files are those that the check has read, and the plan ran once."""
    name = f"{database}.t"
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    src = frame(spark, (1, "a", D1), (2, "b", D2), (3, "c", D2)).mapInArrow(counted, LAYOUT)
    checked = []

    def check(staged):
        checked.extend(Path(f).name for f in staged.inputFiles())

    upsert(spark, src, name, "id", part, check=check)
    assert {f.name for f in table_files(spark, name)} == set(checked)
    assert spark.table(name).count() == 3
    assert runs.value == 3


def test_new_partitions_are_not_written_again(spark, database):
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D2)), name, "id", "file_date")
    checked = []
    check = lambda staged: checked.extend(Path(f).name for f in staged.inputFiles())
    src = frame(spark, (2, "B", D2), (3, "c", D3))
    upsert(spark, src, name, "id", "file_date", check=check)
    again = {f.name for f in live_files(spark, name)} & set(checked)
    assert len(again) == 1 and len(checked) == 2  # that of the new partition
    assert table_files(spark, name) == live_files(spark, name)


def test_of_two_merges_that_overlap_one_fails(spark, database, part):
    """The second starts and ends while the first one runs; the first one's rows stay out."""
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D1)), name, "id", part)

    def check(_):
        upsert(spark, frame(spark, (2, "other", D1)), name, "id", part)

    with pytest.raises(ConcurrentMerge):
        upsert(spark, frame(spark, (1, "mine", D1)), name, "id", part, check=check)
    assert rows(spark.table(name).select("id", "v")) == [(1, "a"), (2, "other")]
    assert table_files(spark, name) == live_files(spark, name)
    upsert(spark, frame(spark, (1, "mine", D1)), name, "id", part)
    assert rows(spark.table(name).select("id", "v")) == [(1, "mine"), (2, "other")]


def test_a_merge_does_not_start_while_another_switches(spark, database, part, monkeypatch):
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1)), name, "id", part)
    src = frame(spark, (1, "b", D1))
    with monkeypatch.context() as lost:
        lost.setattr(commits.Commits, "close", lambda *_: None)  # the driver dies before it
        upsert(spark, src, name, "id", part)
    with pytest.raises(ConcurrentMerge):
        upsert(spark, src, name, "id", part)
    monkeypatch.setattr(commits, "LEASE", 0.0)  # the claim has run out
    upsert(spark, src, name, "id", part)
    assert rows(spark.table(name).select("id", "v")) == [(1, "b")]


def test_sweep_deletes_what_a_broken_merge_left(spark, database, part, monkeypatch):
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D2)), name, "id", part)
    moved = frame(spark, (1, "A", D2), (3, "c", D3))
    with monkeypatch.context() as broken:
        broken.setattr(tables, "discard", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            upsert(spark, moved, name, "id", part)
    upsert(spark, moved, name, "id", part)
    assert table_files(spark, name) > live_files(spark, name)
    assert sweep(spark, name) == []  # too young: a running merge may have written them
    assert sweep(spark, name, older_than=0.0)
    assert table_files(spark, name) == live_files(spark, name)
    assert rows(spark.table(name).select("id", "v")) == [(1, "A"), (2, "b"), (3, "c")]
    assert sweep(spark, name, older_than=0.0) == []
    upsert(spark, frame(spark, (2, "B", D1)), name, "id", part)
    assert rows(spark.table(name).select("id", "v")) == [(1, "A"), (2, "B"), (3, "c")]


def test_null_keys_never_match(spark, database, part):
    name = f"{database}.t"
    upsert(spark, frame(spark, (None, "a", D1), (1, "b", D1)), name, "id", part)
    upsert(spark, frame(spark, (None, "c", D1)), name, "id", part)
    got = rows(spark.table(name).select("id", "v"))
    assert got == [(1, "b"), (None, "a"), (None, "c")]


def test_null_partition(spark, database):
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", None), (2, "b", D1)), name, "id", "file_date")
    upsert(spark, frame(spark, (1, "A", None), (3, "c", None)), name, "id", "file_date")
    assert rows(spark.table(name).select("id", "v")) == [(1, "A"), (2, "b"), (3, "c")]


def test_other_partitions_are_left_alone(spark, database):
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1), (2, "b", D2)), name, "id", "file_date")
    files = lambda day: {
        r[0] for r in spark.table(name).filter(F.col("file_date") == day)
        .select("_metadata.file_path").collect()
    }
    before = files(D1), files(D2)
    upsert(spark, frame(spark, (2, "B", D2)), name, "id", "file_date")
    assert files(D1) == before[0] and files(D2) != before[1]


def test_duplicate_source_keys_are_refused(spark, database):
    name = f"{database}.t"
    with pytest.raises(DuplicateKeys):
        upsert(spark, frame(spark, (1, "a", D1), (1, "b", D1)), name, "id")
    assert not spark.catalog.tableExists(name)


def test_other_columns_are_refused(spark, database):
    name = f"{database}.t"
    upsert(spark, frame(spark, (1, "a", D1)), name, "id")
    with pytest.raises(ValueError, match="columns"):
        upsert(spark, frame(spark, (1, "a", D1)).withColumn("more", F.lit(1)), name, "id")


def test_upsert_counts(spark, database, part):
    name = f"{database}.t"
    assert upsert(spark, frame(spark, (1, "a", D1), (2, "b", D1)), name, "id", part) == Merged(2, 0)
    src = frame(spark, (2, "B", D2), (3, "c", D1), (None, "d", D1))
    assert upsert(spark, src, name, "id", part) == Merged(2, 1)


def test_overwrite_replaces_the_schema_and_raises(spark, database):
    name = f"{database}.t"
    write_table(frame(spark, (1, "a", D1)), name)
    write_table(spark.range(3).toDF("k"), name)
    assert spark.table(name).columns == ["k"]
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        write_table(spark.range(1), name, mode="error")


def test_scan_table_reraises(spark):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        scans.scan_table(spark, "no_such_table")


def test_landing_replaces_only_the_dates_that_come_in(spark, tmp_path):
    path = str(tmp_path / "landed")
    land_parquet(frame(spark, (1, "a", D1), (2, "b", D2)), path)
    land_parquet(frame(spark, (3, "c", D2)), path)
    assert rows(spark.read.parquet(path).select("id", "file_date")) == [(1, D1), (3, D2)]


def test_run_window_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "landed")
    land_parquet(frame(spark, (1, "a", D1), (2, "b", D2), (3, "c", D3)), path)
    src = scans.weekly_parquet(path, "FEED")
    out = scans.with_provenance(
        scans.scan(spark, src), "FEED", dated=True, window=("2024-01-10", "2024-01-16")
    )
    assert rows(out.select("id")) == [(2,)]
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_date" in text


def test_run_window_skips_flat_files_by_name(spark, tmp_path):
    """Files lie side by side, named by date: those outside the window are not opened."""
    for day in (D1, D2, D3):
        pq.write_table(pa.table({"k": [1, 2]}), tmp_path / f"{day}.parquet")
    src = scans.weekly_parquet(str(tmp_path), "FEED")
    out = scans.with_provenance(
        scans.scan(spark, src), "FEED", dated=True, window=(D2, D2)
    ).drop("ldts")
    assert rows(out.select("k", "file_date")) == [(1, D2), (2, D2)]
    assert files_read(out) == 1


def files_read(df) -> int:
    """Files opened by the only scan of a frame that has run."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan"):
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        elif "QueryStage" in node.nodeName():
            node = node.plan()
        else:
            node = node.children().apply(0)
    return node.metrics().get("numFiles").get().value()


def test_windowed_table_read_prunes(spark, database):
    name = f"{database}.t"
    write_table(frame(spark, (1, "a", D1), (2, "b", D2)), name, partition_by="file_date")
    df = spark.table(name).filter(in_run_window("file_date", "2024-01-10", "2024-01-16"))
    assert "PartitionFilters: [isnotnull(file_date" in plan(df)


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    """One date holds nearly all rows; adaptive execution splits it."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32KB",
    }
    for key, size in settings.items():
        spark.conf.set(key, size)
    try:
        df = spark.range(0, 400_000, 1, 8).select(
            "id",
            F.md5(F.col("id").cast("string")).alias("v"),
            F.when(F.col("id") < 399_000, F.lit(D1)).otherwise(F.lit(D2)).alias("file_date"),
        )
        land_parquet(df, str(tmp_path / "hot"))
    finally:
        for key in settings:
            spark.conf.unset(key)
    hot = list((tmp_path / "hot" / f"file_date={D1}").glob("*.parquet"))
    assert len(hot) > 4
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 400_000


# ---- CSV -------------------------------------------------------------------
def test_export_is_sorted_gzip_with_header(spark, tmp_path):
    data = [("Åland, the islands", 2, 12.5), ('say "hi"', 1, None), ("na", 3, 0.0)]
    df = spark.createDataFrame(data, "name string, rank int, pct double")
    export_csv_gz(df, str(tmp_path / "v"), "rank")
    files = sorted(Path(tmp_path / "v").glob("*.csv.gz"))
    assert len(files) == 1
    lines = gzip.decompress(files[0].read_bytes()).decode().splitlines()
    assert lines[0] == "name,rank,pct"
    assert [line.rsplit(",", 2)[1] for line in lines[1:]] == ["1", "2", "3"]
    back = scans.scan_export(spark, str(tmp_path / "v"), "name string, rank int, pct double")
    assert rows(back) == sorted(data, key=repr)


def test_large_export_keeps_its_order_over_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_csv_gz(spark.range(5000).orderBy(F.rand(3)), str(tmp_path / "v"), "id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(Path(tmp_path / "v").glob("*.csv.gz"))
    ids = [
        int(x) for f in files for x in gzip.decompress(f.read_bytes()).decode().splitlines()[1:]
    ]
    assert len(files) > 1 and ids == list(range(5000))


def test_lookup_csv(spark, tmp_path):
    (tmp_path / "countries.csv").write_text(
        'Country,Country_code\nNamibia,na\n"Tanzania, United Republic of",tz\n'
    )
    src = scans.csv_lookup(str(tmp_path), "LOOKUP", schemas.RAW_COUNTRIES)
    assert rows(scans.scan(spark, src)) == [
        ("Namibia", "na"), ("Tanzania, United Republic of", "tz")
    ]


# ---- scratch space ---------------------------------------------------------
def test_scratch_is_the_shared_folder_of_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(shared_root(spark))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_staged_rows_do_not_change(spark):
    stamped = spark.range(3).withColumn("at", F.current_timestamp())
    staged, _ = stage(stamped)
    first = rows(staged)
    assert rows(staged) == first and isinstance(first[0][1], datetime)


def test_a_partition_that_is_replaced_whole_is_not_merged(spark, database, monkeypatch):
    name = f"{database}.replaced"
    columns = "id string, day string, n int"

    def load(*rows):
        return tables.upsert(spark, spark.createDataFrame(rows, columns), name, "id", "day")

    load(("a", "1", 1), ("b", "1", 1), ("c", "2", 1), ("d", "2", 1), ("e", "3", 1))
    written = []
    write = tables._write
    monkeypatch.setattr(tables, "_write", lambda df, path, *more: written.append(path) or write(df, path, *more))
    # All of day 1; all of day 3, which moves to day 4.
    done = load(("a", "1", 2), ("b", "1", 2), ("e", "4", 2))
    assert (done.inserted, done.updated) == (0, 3)
    assert len(written) == 1
    held = [("a", "1", 2), ("b", "1", 2), ("c", "2", 1), ("d", "2", 1), ("e", "4", 2)]
    assert rows(spark.table(name).select("id", "day", "n")) == held
    # A part of day 2.
    load(("c", "2", 3))
    assert len(written) == 3
    held[2] = ("c", "2", 3)
    assert rows(spark.table(name).select("id", "day", "n")) == held


def test_moved_digests_are_packed(spark, database):
    df = spark.createDataFrame([("0" * 32, "f" * 32, "1"), ("x", None, "1")], "id string, fk string, day string")
    text = plan(tables._gathered(df, "day", ("id", "fk")))
    # What is packed is binary below the exchange and text above it.
    assert text.index("substring") < text.index("REBALANCE_PARTITIONS_BY_COL") < text.index("unhex")
    tables.upsert(spark, df, f"{database}.digests", "id", "day", hashed=("fk",))
    assert rows(spark.table(f"{database}.digests").select("id", "fk", "day")) == rows(df)
