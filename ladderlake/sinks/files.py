"""File sinks: landed raw files and exported views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land_parquet(df: DataFrame, path: str, by: str = "file_date") -> None:
    """Land files under one directory per file date, replacing the dates that come in.

    The rebalance gathers each date into few files and, through adaptive execution,
    still splits a date too large for one task.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def land_nanos(df: DataFrame, path: str, *columns: str) -> None:
    """Land files as data frame libraries write them: these timestamps with nanoseconds.

    Spark has no type for them, so each task writes its rows with Arrow, under another name
    first, which only a whole file loses. `path` is a folder that all executors share.
    """
    root = path if not path.startswith("file:/") else "/" + path.removeprefix("file:").lstrip("/")

    def write(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        files, folder = FileSystem.from_uri(root)
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}.parquet"
        unfinished = f"{folder}/.{name}-{task.taskAttemptId()}"
        out, rows = None, 0
        for batch in batches:
            nanos = pa.timestamp("ns", "UTC")
            fields = [f.with_type(nanos) if f.name in columns else f for f in batch.schema]
            table = pa.Table.from_batches([batch]).cast(pa.schema(fields))
            if out is None:
                files.create_dir(folder, recursive=True)
                out = pq.ParquetWriter(unfinished, table.schema, filesystem=files)
            out.write_table(table)
            rows += table.num_rows
        if out:
            out.close()
            files.move(unfinished, f"{folder}/{name}")
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    df.mapInArrow(write, "rows bigint").agg(F.sum("rows")).collect()


def land_json(df: DataFrame, path: str) -> None:
    """Land documents, one JSON object per line."""
    df.write.mode("overwrite").json(path)


def export_csv_gz(df: DataFrame, path: str, *sort_by: str) -> None:
    """Export a view as sorted gzip CSV with header.

    The sort is distributed and the part files follow its order. Adaptive execution
    merges small partitions, so a small view is one file; a large one is never pulled
    through one task.
    """
    (
        df.orderBy(*sort_by)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("compression", "gzip")
        .csv(path)
    )
