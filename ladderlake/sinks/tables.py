"""Table sinks: overwrite and keyed upsert."""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ladderlake.functions.columns import packed_text, unpacked_text
from ladderlake.operators.joins import split_by_match
from ladderlake.sinks import key_index
from ladderlake.sinks.commits import LEASE, Commits
from ladderlake.sinks.workspace import (
    children,
    discard,
    exists,
    partition_folder,
    rename,
    stage,
)

log = logging.getLogger(__name__)

# Table formats that can merge rows in place.
MERGING_FORMATS = ("delta", "iceberg")
# Folders of a partitioned table that hold the files of its merges, and its commits.
MERGES, COMMITS = "_merges", "_commits"


class DuplicateKeys(ValueError):
    """The source of an upsert holds several rows for one key."""


@dataclass(frozen=True)
class Merged:
    """How many source rows an upsert inserted, and how many replaced a row of the table."""

    inserted: int
    updated: int


def write_table(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    partition_by: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Write a managed table; overwriting replaces its schema too. Errors propagate."""
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
    writer = _writer(df, fmt).mode(mode).option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    log.info("wrote table %s (%s)", table, mode)


def _writer(df: DataFrame, fmt: str):
    """A writer of table files: hex digests are half as long under zstd, and as long as ever
    under the default codec."""
    writer = df.write.format(fmt)
    return writer.option("compression", "zstd") if fmt.lower() == "parquet" else writer


def merged_rows(src: DataFrame, tgt: DataFrame, key: str) -> DataFrame:
    """Result of an upsert: every source row, and the target rows no source row replaces."""
    _, kept = split_by_match(tgt, src, key)
    return src.unionByName(kept)


def require_unique(src: DataFrame, key: str) -> None:
    repeated = src.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    if not repeated.isEmpty():
        raise DuplicateKeys(f"several source rows share a value of {key}")


def upsert(
    spark: SparkSession,
    src: DataFrame,
    table: str,
    key: str,
    partition_by: str | None = None,
    fmt: str = "parquet",
    check: Callable[[DataFrame], None] | None = None,
    hashed: Sequence[str] = (),
) -> Merged:
    """Update the rows whose key the table holds, insert the others, delete none.

    The table is created if it is missing. A source row with a null key matches nothing and is
    inserted. The plan of `src` runs once: its rows are written as files of the table's own
    layout, which `check` reads, and which become the table's partitions by location where no
    row of the table remains beside them: on a first load all of them, later those of new
    partitions. `check` raises to keep the rows out; without one, keys must be unique.

    Partitions that get rows or lose replaced ones are written anew beside the old ones; one
    that loses all its rows is not read for it, and what arrived is the partition. Which those
    are says an index of keys (see `key_index`), so no other partition is read. `hashed` names
    columns beside the key that hold hex digests; shuffles carry these packed. Then the
    commit is claimed (see `commits`), the catalog is pointed at the new files, and only then
    are the old ones deleted. A merge that broke off anywhere has lost no row that the table
    held and the source does not replace; running it again completes it, and `sweep` deletes
    what it left behind.
    """
    check = check or partial(require_unique, key=key)
    first = not spark.catalog.tableExists(table)
    about = None if first else _details(spark, table)
    if (fmt if first else about["Provider"].lower()) in MERGING_FORMATS:
        done = _merge_in_place(spark, src, table, key, partition_by, fmt, first, check)
    elif first:
        done = _first_load(spark, src, table, key, partition_by, fmt, check, hashed)
    else:
        # An earlier merge may have broken off after its files changed.
        spark.catalog.refreshTable(table)
        if sorted(src.columns) != sorted(spark.table(table).columns):
            raise ValueError(f"columns of the source and of {table} differ")
        load = _merge_partitions if partition_by else _merge_whole
        done = load(spark, src, table, about, key, partition_by, check, hashed)
    log.info("merged into %s: %d inserted, %d updated", table, done.inserted, done.updated)
    return done


def _merge_in_place(
    spark: SparkSession,
    src: DataFrame,
    table: str,
    key: str,
    partition_by: str | None,
    fmt: str,
    first: bool,
    check: Callable[[DataFrame], None],
) -> Merged:
    """A merge of a format that has transactions of its own."""
    staged, scratch = stage(src, "merge")
    try:
        check(staged)
        if first:
            write_table(staged, table, partition_by=partition_by, fmt=fmt)
            return Merged(staged.count(), 0)
        updated = split_by_match(staged, spark.table(table), key)[0].count()
        same_key = F.col(f"src.{key}") == F.col(f"tgt.{key}")
        (
            staged.alias("src").mergeInto(f"{table} AS tgt", same_key)
            .whenMatched().updateAll().whenNotMatched().insertAll().merge()
        )
        return Merged(staged.count() - updated, updated)
    finally:
        discard(spark, scratch)


def _write(
    df: DataFrame, path: str, part: str | None, fmt: str, hashed: Sequence[str] = ()
) -> DataFrame:
    """Write files in the layout of a table and hand back what they hold."""
    dealt = _gathered(df, part, hashed) if part else df
    writer = _writer(dealt, fmt)
    (writer.partitionBy(part) if part else writer).save(path)
    written = df.sparkSession.read.format(fmt).schema(df.schema).load(path)
    return written.select(*df.columns)


def _gathered(df: DataFrame, part: str, hashed: Sequence[str]) -> DataFrame:
    """The rows of a partition value in few tasks; text columns of digests are packed on the way."""
    texts = [c for c in dict.fromkeys(hashed) if c != part and _is_text(df, c)]
    packed = df.withColumns({c: packed_text(c) for c in texts}) if texts else df
    moved = packed.hint("rebalance", F.col(part))
    return moved.withColumns({c: unpacked_text(c) for c in texts}) if texts else moved


def _by_packed(df: DataFrame, key: str) -> DataFrame:
    """The rows with their key packed if it is text: equal keys stay equal, joins move less."""
    return df.withColumn(key, packed_text(key)) if _is_text(df, key) else df


def _is_text(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType == StringType()


def _first_load(
    spark: SparkSession,
    src: DataFrame,
    table: str,
    key: str,
    part: str | None,
    fmt: str,
    check: Callable[[DataFrame], None],
    hashed: Sequence[str],
) -> Merged:
    """Write the rows once, beside where the table will be; once checked, they are the table."""
    base = _default_path(spark, table)
    parent, name = base.rsplit("/", 1)
    path = f"{parent}/_staged/{name}-{uuid.uuid4().hex}"
    try:
        staged = _write(src, path, part, fmt, (key, *hashed))
        check(staged)
        counts = _counts(staged, part) if part else {None: staged.count()}
        empty = spark.createDataFrame([], src.schema).write.format(fmt)
        (empty.partitionBy(part) if part else empty).saveAsTable(table)
        if part:
            version = f"{base}/{MERGES}/{uuid.uuid4().hex}"
            rename(spark, path, version)
            _add(spark, table, part, {v: f"{version}/{partition_folder(spark, part, v)}" for v in counts})
            spark.catalog.refreshTable(table)
            key_index.build(spark, table, key_index.entries(spark.table(table), key, part))
        else:
            version = f"{base}__v_{uuid.uuid4().hex}"
            rename(spark, path, version)
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(version)}'")
            discard(spark, base)
        spark.catalog.refreshTable(table)
        return Merged(sum(counts.values()), 0)
    except BaseException:
        discard(spark, path)
        raise


def _merge_partitions(
    spark: SparkSession,
    src: DataFrame,
    table: str,
    about: dict[str, str],
    key: str,
    part: str,
    check: Callable[[DataFrame], None],
    hashed: Sequence[str],
) -> Merged:
    """Rewrite the partitions that get rows or lose replaced ones; touch and read no other.

    What reaches the driver is lists of partition values, as long as the table has partitions.
    """
    if about.get("Partition Provider") != "Catalog":
        raise ValueError(f"the catalog does not list the partitions of {table}")
    base, fmt = about["Location"].rstrip("/"), about["Provider"]
    commits = Commits(f"{base}/{COMMITS}")
    read = commits.start(spark)
    arrived, merged = (f"{base}/{MERGES}/{uuid.uuid4().hex}" for _ in range(2))
    try:
        tgt = spark.table(table)
        digests = (key, *hashed)
        incoming = _write(src.select(*tgt.columns), arrived, part, fmt, digests)
        check(incoming)
        index = key_index.current(spark, table, key, part)
        asked = key_index.entries(incoming, key, part)
        found, scratch = stage(key_index.looked_up(spark, index, asked), "known")
        try:
            held = tgt.filter(_one_of(part, _values(found.where("found").select("held"))))
            keys = _by_packed(incoming.select(key), key)
            replaced = split_by_match(_by_packed(held.select(key, part), key), keys, key)[0]
            losing = _counts(replaced, part)
            had = _counts(tgt.filter(_one_of(part, losing.keys())), part)
            counts = _counts(incoming, part)
            listed = _listed(spark, table, part)
            places = {v: partition_folder(spark, part, v) for v in counts.keys() | losing.keys()}
            spent = {v for v in losing if losing[v] == had[v]}
            fresh = {v for v in counts if places[v] not in listed}
            rewritten = places.keys() - fresh - spent
            if rewritten:
                touched = _one_of(part, rewritten)
                # Rows that move to a new partition leave their old one, too.
                kept = split_by_match(_by_packed(tgt.filter(touched), key), keys, key)[1]
                if _is_text(tgt, key):
                    kept = kept.withColumn(key, unpacked_text(key))
                _write(incoming.filter(touched).unionByName(kept), merged, part, fmt, digests)
            key_index.add(spark, table, index, key_index.missing(found))
        finally:
            discard(spark, scratch)
        mine = commits.claim(spark, read)
    except BaseException:
        discard(spark, arrived, merged)
        raise
    try:
        now = {v: f"{merged}/{places[v]}" for v in rewritten if exists(spark, f"{merged}/{places[v]}")}
        now |= {v: f"{arrived}/{places[v]}" for v in spent & counts.keys()}
        _add(spark, table, part, {v: f"{arrived}/{places[v]}" for v in fresh})
        for value, path in now.items():
            _point(spark, table, part, value, path)
        gone = (rewritten | spent) - now.keys()
        for value in gone:  # every row of it moved elsewhere
            _spec_dropped(spark, table, _spec(part, value))
        spark.catalog.refreshTable(table)
        unused = [f"{arrived}/{places[v]}" for v in counts.keys() & rewritten]
        discard(spark, *(listed[places[v]] for v in rewritten | spent), *unused)
    finally:
        commits.close(spark, mine)
    key_index.tidy(spark, table, key, part)
    updated = sum(losing.values())
    return Merged(sum(counts.values()) - updated, updated)


def _merge_whole(
    spark: SparkSession,
    src: DataFrame,
    table: str,
    about: dict[str, str],
    key: str,
    _: None,
    check: Callable[[DataFrame], None],
    hashed: Sequence[str],
) -> Merged:
    """Write the merged rows beside the table, then point the table at them."""
    old = about["Location"].rstrip("/")
    base = old.split("__v_")[0]
    commits = Commits(f"{base}__commits")
    read = commits.start(spark)
    new = f"{base}__v_{uuid.uuid4().hex}"
    try:
        staged, scratch = stage(src, "merge")
        try:
            check(staged)
            tgt = spark.table(table)
            updated = split_by_match(tgt.select(key), staged, key)[0].count()
            _write(merged_rows(staged, tgt, key).select(*tgt.columns), new, None, about["Provider"])
            count = staged.count()
        finally:
            discard(spark, scratch)
        mine = commits.claim(spark, read)
    except BaseException:
        discard(spark, new)
        raise
    try:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{_quoted(new)}'")
        spark.catalog.refreshTable(table)
        discard(spark, old)
    finally:
        commits.close(spark, mine)
    return Merged(count - updated, updated)


def sweep(spark: SparkSession, table: str, older_than: float = LEASE) -> list[str]:
    """Delete what broken-off merges left beside a table; returns the folders deleted.

    Live is what the catalog points at. Folders changed within the last `older_than` seconds
    are left alone, since a merge that is still running may have written them.
    """
    about = _details(spark, table)
    old = about["Location"].rstrip("/")
    base = old.split("__v_")[0]
    parent, name = base.rsplit("/", 1)
    before = time.time() - older_than
    gone = [
        f"{parent}/_staged/{n}" for n, changed in children(spark, f"{parent}/_staged").items()
        if n.startswith(f"{name}-") and changed <= before
    ]
    if about.get("Partition Provider") == "Catalog":
        part = _partition_column(spark, table)
        live = {_path(place) for place in _listed(spark, table, part).values()}
        folders = {f"{base}/{n}": c for n, c in children(spark, base).items() if "=" in n}
        for version, changed in children(spark, f"{base}/{MERGES}").items():
            whole = f"{base}/{MERGES}/{version}"
            inside = {f"{whole}/{n}": c for n, c in children(spark, whole).items() if "=" in n}
            if any(_path(place) in live for place in inside):
                folders |= inside
            else:
                folders[whole] = max([changed, *inside.values()])
        gone += [f for f, c in folders.items() if _path(f) not in live and c <= before]
    else:
        gone += [
            f"{parent}/{n}" for n, changed in children(spark, parent).items()
            if (n == name or n.startswith(f"{name}__v_")) and changed <= before
            and _path(f"{parent}/{n}") != _path(old)
        ]
    discard(spark, *gone)
    return sorted(gone)


def _add(spark: SparkSession, table: str, part: str, places: dict) -> None:
    """Let the catalog list new partitions, each with its files."""
    specs = [f"{_spec(part, v)} LOCATION '{_quoted(path)}'" for v, path in places.items()]
    for start in range(0, len(specs), 100):
        some = " ".join(specs[start : start + 100])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")


def _point(spark: SparkSession, table: str, part: str, value, path: str) -> None:
    """Let a partition that the catalog lists be the files at `path`."""
    spark.sql(f"ALTER TABLE {table} {_spec(part, value)} SET LOCATION '{_quoted(path)}'")


def _spec_dropped(spark: SparkSession, table: str, spec: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec}")


def _listed(spark: SparkSession, table: str, part: str) -> dict[str, str]:
    """Folder names of the partitions that the catalog lists, and where their files are."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    none = getattr(spark._jvm, "scala.Option").empty()
    found = _catalog(spark).listPartitions(_identifier(spark, table), none)
    places = {}
    for i in range(found.size()):
        listed = found.apply(i)
        value = listed.spec().apply(part)
        places[names.getPartitionPathString(part, value)] = _plain(spark, listed.location())
    return places


def _catalog(spark: SparkSession):
    return spark._jsparkSession.sessionState().catalog()


def _identifier(spark: SparkSession, table: str):
    return spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(table)


def _default_path(spark: SparkSession, table: str) -> str:
    """Where a managed table of this name is put."""
    place = _catalog(spark).defaultTablePath(_identifier(spark, table))
    return _plain(spark, place).rstrip("/")


def _plain(spark: SparkSession, uri) -> str:
    """A location of the catalog as paths are written, without escapes."""
    return spark._jvm.org.apache.hadoop.fs.Path(uri).toString()


def _partition_column(spark: SparkSession, table: str) -> str:
    return next(c.name for c in spark.catalog.listColumns(table) if c.isPartition)


def _path(place: str) -> str:
    """A location without its scheme, so that spellings of it compare."""
    return re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?", "", place).rstrip("/")


def _spec(part: str, value) -> str:
    return f"PARTITION ({part} = {_literal(value)})"


def _values(column: DataFrame) -> set:
    return {row[0] for row in column.distinct().collect()}


def _counts(rows: DataFrame, column: str) -> dict:
    """Rows per value. Writers put empty text where they put null, and it is read as null."""
    return {r[0]: r[1] for r in rows.groupBy(column).count().collect()}


def _one_of(column: str, values: set) -> Column:
    known = [v for v in values if v is not None]
    test = F.col(column).isin(known)
    return test | F.col(column).isNull() if None in values else test


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _text(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + _text(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _details(spark: SparkSession, table: str) -> dict[str, str]:
    """Catalog facts of a table: its provider, location and so on."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    start = [r["col_name"] for r in rows].index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[start + 1 :]}
