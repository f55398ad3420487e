"""Which partitions of a table may hold a key, without a look at the table.

The index of a table is a small table of its own: a 64-bit hash of each key beside the value of
its partition, bucketed by the hash. A merge asks it for the partitions of the keys that come
in; the bucketed side is not shuffled, and of the table itself only those partitions are read.

The index may say too much, never too little: entries are added before the table shows the
rows, and what a row leaves behind when it moves, or a hash that two keys share, costs a look
at one more partition and no more. After `APPENDS` merges the index is written anew, without
repetitions and without what no longer holds.

The table names its index in a property. Overwriting the table drops the property, and an index
that is not named is built from the table's key column. Rows that are written past the merge
(INSERT INTO) are not in the index: call `forget` after such a write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX, ADDED = "ladderlake.keys", "ladderlake.keys.appends"
#: Merges after which the index is written anew.
APPENDS = 16


def key_hash(key: str) -> Column:
    return F.xxhash64(F.col(key))


def entries(rows: DataFrame, key: str, part: str) -> DataFrame:
    """(h, part) of all rows with a key."""
    return rows.where(F.col(key).isNotNull()).select(
        key_hash(key).alias("h"), F.col(part).alias("part")
    )


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def current(spark: SparkSession, table: str, key: str, part: str) -> str:
    """The name of the table's index, which is built if there is none."""
    named = properties(spark, table).get(INDEX)
    if named and spark.catalog.tableExists(named):
        return named
    return build(spark, table, entries(spark.table(table), key, part))


def build(spark: SparkSession, table: str, found: DataFrame) -> str:
    """Write the index of a table anew and let the table name it."""
    old = properties(spark, table).get(INDEX)
    name = f"{table}__keys_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by hash first, so that one shuffle serves the distinct and the buckets.
    each = found.repartition(buckets, "h").distinct()
    each.write.bucketBy(buckets, "h").saveAsTable(name)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{INDEX}' = '{name}', '{ADDED}' = '0')")
    if old:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return name


def forget(spark: SparkSession, table: str) -> None:
    """Drop the index of a table that was written past the merge; the next merge builds one."""
    named = properties(spark, table).get(INDEX)
    if named:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{INDEX}', '{ADDED}')")
        spark.sql(f"DROP TABLE IF EXISTS {named}")


def looked_up(spark: SparkSession, index: str, asked: DataFrame) -> DataFrame:
    """The entries asked for, each once, beside those of the index with the same hash: `held`
    is their partition where `found` is true. The index is not shuffled."""
    each = asked.repartition(_buckets(spark, index), "h").distinct()
    entry = spark.table(index).select("h", F.col("part").alias("held"), F.lit(True).alias("found"))
    return each.join(entry, "h", "left")


def missing(found: DataFrame) -> DataFrame:
    """Looked-up entries to add. One that the index holds beside another partition of its hash
    is among them, too; `tidy` drops such repetitions."""
    same = F.col("found") & F.col("part").eqNullSafe(F.col("held"))
    return found.where(~F.coalesce(same, F.lit(False))).select("h", "part")


def add(spark: SparkSession, table: str, index: str, new: DataFrame) -> None:
    """Add entries to the index."""
    buckets = _buckets(spark, index)
    new.repartition(buckets, "h").write.bucketBy(buckets, "h").mode("append").saveAsTable(index)
    added = int(properties(spark, table).get(ADDED, "0")) + 1
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{ADDED}' = '{added}')")


def tidy(spark: SparkSession, table: str, key: str, part: str) -> None:
    """Write an index anew that many merges have added to."""
    if int(properties(spark, table).get(ADDED, "0")) >= APPENDS:
        build(spark, table, entries(spark.table(table), key, part))


def _buckets(spark: SparkSession, index: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {index}").collect()
    return int(next(r["data_type"] for r in rows if r["col_name"] == "Num Buckets"))
