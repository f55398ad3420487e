"""Exact deduplication: 128-bit content hash, smallest stable id, bytes compared inside groups.

Texts are equal when they are identical after every run of white space (0x20, 0x09-0x0D)
became one space. Only DataFrame expressions run here.

Plan: one aggregate on (hash, text) with a map-side combine, so that copies shrink to one
row per task before the only shuffle of texts. Its key holds the text itself: texts that
share a hash but differ in a byte stay apart. The classes then go back to the rows by hash
and by the 256-bit digest that the result carries anyway; that join moves no texts, and a
class with a third of all rows is an equi-join key that adaptive execution splits.

Null texts count as empty; empty texts are equal to each other. A null id is kept as a row;
it is the class's `keep_id` only if no row of the class has an id, and then all are kept.
Rows that repeat an id and its text are all of the class, and all with the smallest id are
marked as kept; `keep_first` leaves one row of each class. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import one_of_each

#: White space of the contract as a regular expression.
RUNS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def content_hash(text: Column) -> Column:
    """128 bits of the normalised text."""
    return F.unhex(F.md5(text))


def classes(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    digest: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("norm"))
    groups = (
        texts.groupBy(digest(F.col("norm")).alias("hash"), "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    rows = texts.select(
        "doc_id", digest(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256")
    )
    return rows.join(groups, ["hash", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_first(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each class, with all its columns: one with the smallest id.

    Of rows that repeat that id, or of a class without any id, one stays.
    """
    marks = (
        classes(docs, text, doc_id)
        .groupBy(F.col("doc_id").alias("marked_id"), F.col("text_sha256").alias("marked_key"))
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("not kept or n > 1")
        .drop("n")
    )
    return one_of_each(docs, marks, doc_id, F.sha2(normalised(F.col(text)), 256))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM texts
"""
