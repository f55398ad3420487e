"""Batch sources: configured file scans, catalog tables, exported views."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ladderlake import schemas
from ladderlake.functions.columns import file_date_of, load_time, nanos_to_timestamp
from ladderlake.operators.filters import in_run_window

log = logging.getLogger(__name__)

NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"
#: Column with the full path of a row's file, until `with_provenance` replaces it.
FILE_PATH = "__file_path"


@dataclass(frozen=True)
class FileSource:
    """Where and how one kind of raw file is read.

    `fmt`: parquet, csv, json (a document per line) or documents (JSON files that hold one
    document or one array of documents each, over any number of lines).
    `dated`: the files are named by, or partitioned by, a file date.
    `schema`: DDL; always given for JSON and CSV, so nothing is inferred from the data
    (an empty nested array would be inferred as strings). Parquet carries its own.
    `nanos`: timestamp columns the files hold with nanosecond precision.
    `mixed`: some files have them in microseconds instead; which ones, their footers say.
    """

    path: str
    fmt: str
    source: str
    dated: bool = False
    schema: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    nanos: tuple[str, ...] = ()
    mixed: bool = False


def weekly_parquet(
    path: str, source: str, nanos: tuple[str, ...] = (), mixed: bool = False
) -> FileSource:
    return FileSource(path, "parquet", source, dated=True, nanos=nanos, mixed=mixed)


def json_lines(path: str, source: str, schema: str) -> FileSource:
    """Landed documents, one JSON object per line; large files are split."""
    return FileSource(path, "json", source, schema=schema)


def json_documents(path: str, source: str, schema: str) -> FileSource:
    """Files as an interface delivers them: one document or array of documents per file."""
    return FileSource(path, "documents", source, schema=schema)


def csv_lookup(path: str, source: str, schema: str) -> FileSource:
    return FileSource(path, "csv", source, schema=schema, options={"header": "true"})


def scan(spark: SparkSession, src: FileSource) -> DataFrame:
    """The files as a DataFrame; nanosecond timestamps become Spark timestamps.

    Text that does not fit its schema fails the job: a malformed record is never read as
    nulls. A source with `nanos` needs `spark.sql.legacy.parquet.nanosAsLong` set on the
    session, the only way Spark offers to such files; the session is left as it is.
    """
    if src.fmt == "documents":
        return _documents(spark, src)
    options = {"mode": "FAILFAST"} if src.fmt in ("json", "csv") else {}
    reader = spark.read.format(src.fmt).options(**options | src.options)
    if src.schema:
        reader = reader.schema(schemas.struct(src.schema))
    if src.nanos and spark.conf.get(NANOS_AS_LONG, "false").lower() != "true":
        raise ValueError(f"{src.path} holds nanosecond timestamps: set {NANOS_AS_LONG}")
    if src.mixed:
        return _mixed(spark, src)
    df = reader.load(src.path)
    as_counts = [c for c in src.nanos if dict(df.dtypes)[c] == "bigint"]
    return df.withColumns({c: nanos_to_timestamp(c) for c in as_counts}) if as_counts else df


def _mixed(spark: SparkSession, src: FileSource) -> DataFrame:
    """Files of which some count nanoseconds and some hold microseconds.

    A scan has one type per column, and counts of either unit would be read as the other. So
    the files are grouped by what their footers say of the columns, and each group is a scan.
    Footers are opened one after the other: sources of this kind are files by week.
    """
    listing = spark.read.options(**src.options).format(src.fmt)
    groups: dict[tuple[bool, ...], list[str]] = {}
    for file in _data_files(spark, src):
        groups.setdefault(_counts_nanos(spark, file, src.nanos), []).append(file)
    scans = []
    for counted, files in groups.items():
        # The base keeps partition columns such as the file date.
        df = listing.option("basePath", src.path).load(files)
        df = df.select("*", F.col("_metadata.file_path").alias(FILE_PATH))
        stamps = [
            nanos_to_timestamp(c) if nanos else F.col(c).cast("timestamp")
            for c, nanos in zip(src.nanos, counted)
        ]
        scans.append(df.withColumns(dict(zip(src.nanos, stamps))))
    return reduce(DataFrame.unionByName, scans)


def _data_files(spark: SparkSession, src: FileSource) -> list[str]:
    """Paths of the files, as they are listed without being opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src.path)
    return [r[0] for r in files.select("path").where(F.col("length") > 0).collect()]


def _counts_nanos(spark: SparkSession, file: str, columns: tuple[str, ...]) -> tuple[bool, ...]:
    """Whether each column of a file is a count of nanoseconds."""
    hadoop = spark._jvm.org.apache.parquet.hadoop
    path = spark._jvm.org.apache.hadoop.fs.Path(file)
    where = hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = hadoop.ParquetFileReader.open(where)
    try:
        schema = reader.getFooter().getFileMetaData().getSchema()
        kinds = [schema.getType(schema.getFieldIndex(c)) for c in columns]
        return tuple(_is_count(kind) for kind in kinds)
    finally:
        reader.close()


def _is_count(kind) -> bool:
    stamp = kind.getLogicalTypeAnnotation()
    whole = kind.asPrimitiveType().getPrimitiveTypeName().toString() == "INT64"
    return whole and (stamp is None or "NANOS" in stamp.toString())


def _documents(spark: SparkSession, src: FileSource) -> DataFrame:
    """Whole JSON files.

    The text is parsed inside brackets, so that a second document behind the first one is
    an error and not left out; a file that is an array already is taken as it is.
    """
    layout = ArrayType(schemas.struct(src.schema))
    files = spark.read.options(**src.options).text(src.path, wholetext=True)
    kept = [c for c in files.columns if c != "value"]
    text, strict = F.concat(F.lit("["), "value", F.lit("]")), {"mode": "FAILFAST"}
    parsed = F.when(
        F.col("value").rlike(r"^\s*\["), F.flatten(F.from_json(text, ArrayType(layout), strict))
    ).otherwise(F.from_json(text, layout, strict))
    named = files.select(*kept, F.col("_metadata.file_path").alias(FILE_PATH), parsed.alias("docs"))
    return named.select(FILE_PATH, F.inline("docs"), *kept)


def _place(spark: SparkSession, root: str | None) -> Column:
    """Path of a row's file below the source's folder, decoded; the file name without one."""
    # Paths come percent-encoded; a plus sign stands for itself in them.
    path = F.url_decode(F.regexp_replace(F.col(FILE_PATH), r"\+", "%2B"))
    name = F.element_at(F.split(path, "/"), -1)
    if root is None:
        return name
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    start = F.lit(files.makeQualified(folder).toString() + "/")
    # Schemes of local files differ in their slashes from place to place.
    plain = lambda c: F.regexp_replace(c, r"^([a-z]+):/+", "$1:/")
    return F.when(
        F.startswith(plain(path), plain(start)), F.substring(plain(path), F.length(plain(start)) + 1, F.length(path))
    ).otherwise(name)


def with_provenance(
    df: DataFrame,
    source: str,
    *,
    dated: bool = False,
    window: tuple[date | str, date | str] | None = None,
    loaded_at: Column | None = None,
    root: str | None = None,
) -> DataFrame:
    """Add `fn`, `file_date`, `source` and `ldts` to a file scan.

    `fn` is the path below `root`, so equal rows of files with one name in two folders stay
    two rows. The file date is that of the path's last part.

    The run window is applied before the row dedup, and the load time after it, so the
    dedup shuffles the window only and equal rows stay equal. A `file_date` partition
    column is used as it is, which lets the window prune directories.

    Rows are dealt by all their columns first and made distinct there: a map task that combined
    its own would hold most of a file in memory, since few rows repeat. Dated rows are gathered
    by date later, so their tasks may stay small; others are merged into few tasks at once.
    """
    if FILE_PATH not in df.columns:
        df = df.select("*", F.col("_metadata.file_path").alias(FILE_PATH))
    out = df.withColumn("fn", _place(df.sparkSession, root)).drop(FILE_PATH)
    if dated:
        if "file_date" not in df.columns:
            out = out.withColumn("file_date", file_date_of("fn"))
        if window:
            out = out.filter(in_run_window("file_date", *window))
    parts = [int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))] if dated else []
    out = out.repartition(*parts, *out.columns).dropDuplicates()
    return out.withColumns({"source": F.lit(source).cast("string"), "ldts": load_time(loaded_at)})


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, logging the catalog and schema it resolves in."""
    where = f"{spark.catalog.currentCatalog()}.{spark.catalog.currentDatabase()}"
    try:
        df = spark.table(name)
    except Exception:
        log.error("cannot read table %s in %s", name, where)
        raise
    log.info("reading table %s in %s", name, where)
    return df


def scan_export(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """An exported view: gzip CSV files whose header must name the declared columns."""
    options = {"header": "true", "escape": '"', "enforceSchema": "false"}
    return spark.read.schema(schemas.struct(ddl)).options(**options).csv(path)
