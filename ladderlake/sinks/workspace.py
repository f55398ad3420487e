"""Shared scratch space for staged results.

Executors come and go, so intermediate results live in the folder all of them share:
the one the session names in `spark.checkpoint.dir`. Only a local session that names
none uses a folder of its warehouse, which it shares with nobody else.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/ladderlake/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> tuple[DataFrame, str]:
    """Write a result once and hand back the written rows, cut off from their lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders this package wrote; raises where one is still there."""
    for path in paths:
        files, target = _at(spark, path)
        if not files.delete(target, True) and files.exists(target):
            raise OSError(f"cannot delete {path}")


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _at(spark, path)
    return files.exists(target)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder within its file system; the parent of `to` is made if need be."""
    files, source = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def children(spark: SparkSession, path: str) -> dict[str, float]:
    """Names below a folder and when each was last changed, in epoch seconds."""
    files, folder = _at(spark, path)
    if not files.exists(folder):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(folder)}


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it is there already. Of several callers one succeeds,
    on file systems that create exclusively, such as HDFS."""
    files, target = _at(spark, path)
    files.mkdirs(target.getParent())
    try:
        files.create(target, False).close()
    except Exception as error:  # the JVM's, of a class of the file system's own
        if files.exists(target):
            return False
        raise OSError(f"cannot create {path}") from error
    return True


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def partition_folder(spark: SparkSession, part: str, value) -> str:
    """Name of a partition's folder, as writers make it and the catalog lists it."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    shown = str(value).lower() if isinstance(value, bool) else value
    return names.getPartitionPathString(part, None if value is None else str(shown))
