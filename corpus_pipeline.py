"""A training-data pipeline over `documents`: each stage works on what the one before kept.

    quality classifier -> exact dedup -> SimHash near-dedup -> benchmark decontamination -> BPE

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next stage's docs. All but the last return the
columns they were given. Every stage reads whole tables and whole texts; its decisions are
final. Empty tables go through to an empty result; null texts are empty texts throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ladderlake.llm import bpe, decontaminate, exact_dedup, quality_gam, simhash
from ladderlake.sinks import workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled rows of `docs`."""
    return quality_gam.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of linked fingerprints."""
    return simhash.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of what they decode to."""
    return bpe.digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", clean),
    ("bpe", tokens),
]

#: The classifier and the fingerprints have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs, path = workspace.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            workspace.discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
