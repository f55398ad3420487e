"""Bronze: raw files with provenance, overwritten by each run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from ladderlake import schemas
from ladderlake.functions.columns import conform
from ladderlake.sinks.tables import write_table
from ladderlake.sources.calendar import CALENDAR_END, CALENDAR_START, calendar
from ladderlake.sources.scans import FileSource, scan, with_provenance


def load_files(
    spark: SparkSession,
    src: FileSource,
    table: str,
    window: tuple[date | str, date | str] | None = None,
) -> None:
    """Dated sources keep to the run window and are partitioned by file date, so the
    silver jobs can prune by it."""
    df = with_provenance(
        scan(spark, src), src.source, dated=src.dated, window=window, root=src.path
    )
    write_table(df, table, partition_by="file_date" if src.dated else None)


def load_calendar(
    spark: SparkSession, table: str, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> None:
    write_table(conform(calendar(spark, start, end), schemas.CALENDAR), table)
