"""Quarantine with a ledger of deliveries: what a new delivery covers, it replaces at once.

Rejects lie in folders of their own per file date (or other `by` value) and delivery. The
ledger says for each value which delivery was the last to cover it, with rejects or without
any. A delivery writes its rejects first and then its entry, in one rename: until then readers
see the rejects that were there before, and from then on its own. A value that was delivered
again without a fault thus has no rejects any more. Superseded files are deleted afterwards; if
that breaks off they are hidden by the ledger, and the next delivery of the value deletes them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ladderlake.sinks.commits import Commits
from ladderlake.sinks.workspace import children, discard, partition_folder, rename

#: Partition below `by`: the delivery that rejected the rows.
LANDED = "landed"
_ENTRIES = "_ledger/entries"


def replace_rejects(
    spark: SparkSession, rejects: DataFrame, covered: DataFrame, quarantine: str, by: str
) -> None:
    """Let `rejects` be the quarantine of all values of `by` that `covered` has."""
    quarantine = quarantine.rstrip("/")
    commits = Commits(f"{quarantine}/_ledger/commits")
    read = commits.start(spark)
    delivery = uuid.uuid4().hex
    (
        rejects.withColumn(LANDED, F.lit(delivery))
        .hint("rebalance", F.col(by))
        .write.mode("append")
        .partitionBy(by, LANDED)
        .parquet(quarantine)
    )
    entry = covered.select(F.col(by).cast("string").alias("covered")).distinct()
    new = f"{quarantine}/_ledger/new-{delivery}"
    (
        entry.withColumns({LANDED: F.lit(delivery), "layout": F.lit(rejects.schema.json())})
        .write.parquet(new)
    )
    mine = commits.claim(spark, read)
    try:
        rename(spark, new, f"{quarantine}/{_ENTRIES}/commit={mine}")
    finally:
        commits.close(spark, mine)
    for (value,) in entry.collect():  # as many as there are file dates in a delivery
        folder = f"{quarantine}/{partition_folder(spark, by, value)}"
        old = [n for n in children(spark, folder) if n != f"{LANDED}={delivery}"]
        discard(spark, *(f"{folder}/{n}" for n in old))


def current_rejects(spark: SparkSession, quarantine: str, by: str) -> DataFrame:
    """The rejects of the last delivery of every value."""
    quarantine = quarantine.rstrip("/")
    last = (
        spark.read.parquet(f"{quarantine}/{_ENTRIES}")
        .groupBy("covered")
        .agg(F.max_by(F.struct(LANDED, "layout"), "commit").alias("covered_last"))
    )
    # The layout of the newest entry; all deliveries of one kind of file share theirs.
    newest = spark.read.parquet(f"{quarantine}/{_ENTRIES}").agg(F.max_by("layout", "commit"))
    layout = StructType.fromJson(json.loads(newest.first()[0]))
    if not any("=" in name for name in children(spark, quarantine)):
        return spark.createDataFrame([], layout)
    stored = StructType([*layout.fields]).add(LANDED, "string")
    rejects = spark.read.schema(stored).parquet(quarantine)
    live = rejects[by].cast("string").eqNullSafe(last["covered"]) & (
        rejects[LANDED] == last["covered_last"][LANDED]
    )
    return rejects.join(last, live, "left_semi").select(*layout.names)
