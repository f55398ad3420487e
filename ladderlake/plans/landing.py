"""Landing: what arrives is judged, the good part lands, the rest goes to quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderlake.functions.cleaning import recast
from ladderlake.quality import records
from ladderlake.quality.records import ERRORS, Field
from ladderlake.sinks.files import land_json, land_parquet
from ladderlake.sinks.ledger import replace_rejects
from ladderlake.sinks.workspace import discard, stage


def land_records(
    arrived: DataFrame,
    fields: Sequence[Field],
    path: str,
    quarantine: str,
    casts: Mapping[str, str] | None = None,
    by: str = "file_date",
    manifest: DataFrame | None = None,
) -> None:
    """Judge every record once; land the valid ones by file date, keep the others with
    their reasons. Dates of which no record is valid are left as they are.

    The rejects of a date replace those of an earlier delivery of it, also if there are none:
    a corrected delivery empties the quarantine of its dates (see `ledger`). Dates that a
    `manifest` lists count as delivered even if no record of theirs arrived.
    """
    spark = arrived.sparkSession
    judged, scratch = stage(records.judge(arrived, fields, by), "judged")
    try:
        good = records.accepted(judged)
        if not good.isEmpty():
            land_parquet(recast(good, dict(casts or {})), path, by)
        covered = judged.select(by)
        if manifest is not None:
            covered = covered.union(manifest.select(by))
        replace_rejects(spark, records.quarantined(judged), covered, quarantine, by)
    finally:
        discard(spark, scratch)


def land_documents(
    arrived: DataFrame,
    text: str,
    ddl: str,
    required: Sequence[str],
    path: str,
    quarantine: str,
    delivery: str = "latest",
    fault: str | None = None,
) -> None:
    """Judge JSON documents once; land the valid ones as JSON lines, keep the others' text
    with the reasons. The rejects of a delivery replace those of the same delivery before.

    `fault` is a column of `arrived` that says what is wrong with a document's place in its
    file, as `document_pages` gives it: such a document is rejected for it, and the others of
    its file are judged on their own.
    """
    spark = arrived.sparkSession
    parsed = records.parse_documents(arrived, text, ddl)
    verdicts = records.judge_documents(parsed, ddl, required)
    if fault:
        misplaced = F.when(F.col(fault).isNull(), F.col(ERRORS)).otherwise(F.array(fault))
        verdicts = verdicts.withColumn(ERRORS, misplaced)
    judged, scratch = stage(verdicts, "judged")
    try:
        good = records.accepted(judged)
        if not good.isEmpty():
            land_json(good.select("doc.*").drop(records.CORRUPT), path)
        by = F.lit(delivery).alias("delivery")
        bad = records.quarantined(judged).select(text, ERRORS, by)
        replace_rejects(spark, bad, spark.range(1).select(by), quarantine, "delivery")
    finally:
        discard(spark, scratch)
