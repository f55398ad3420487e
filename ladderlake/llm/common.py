"""What several operators share: shipping the package, durable cuts, Arrow text buffers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderlake.sinks import workspace

#: White space of the contracts: the bytes 0x20 and 0x09 to 0x0D, nothing beyond ASCII.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: ASCII upper case to lower case, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def durable(df: DataFrame) -> DataFrame:
    """The rows cut off from their lineage by a checkpoint in the shared folder.

    The folder is the one that `spark.checkpoint.dir` names; only a local session that
    names none gets one of its own.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(workspace.shared_root(df.sparkSession))
    return df.checkpoint()


def unused(taken: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores before it until no column is called so."""
    known = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in known:
            name = f"_{name}"
        known.add(name.lower())
        out.append(name)
    return out


def one_of_each(docs: DataFrame, marks: DataFrame, doc_id: str, key: Column) -> DataFrame:
    """The rows of `docs` that no mark takes out, with all their columns.

    A mark names rows by id and key (`marked_id`, `marked_key`) and says whether they are
    `kept`: if not, all of them go; if so, they repeat each other and one stays, the first in
    an order over all columns. Rows without a mark stay.
    """
    key_name, id_name, kept, *names = unused(
        docs.columns, "__key", "__id", "kept", "marked_id", "marked_key"
    )
    marks = durable(marks.select("marked_id", "marked_key", "kept").toDF(*names, kept))
    keyed = docs.withColumn(key_name, key)
    marked_id, marked_key = map(F.col, names)
    on = F.col(f"`{doc_id}`").eqNullSafe(marked_id) & (F.col(key_name) == marked_key)
    rest = keyed.join(marks, on, "left_anti").drop(key_name)
    repeats = marks.where(F.col(kept))
    if repeats.isEmpty():
        return rest
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (
        keyed.join(repeats, on, "left_semi")
        .groupBy(F.col(f"`{doc_id}`").alias(id_name), key_name)
        .agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("__row"))
    )
    return rest.union(one.select("__row.*"))


def crc_fold(doc_id, folds: int):
    """crc32 of the id as text, modulo `folds`. A null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def hash_sample(df: DataFrame, bound: int, *columns: str) -> DataFrame:
    """About `bound` rows of a larger frame, all of a smaller one: those whose hash is low.

    The share is set by a count, so no task returns more than its part of the sample.
    """
    total = df.count()
    if total <= bound:
        return df
    share = int(bound / total * (1 << 40))
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) < share)


def sampled_labels(
    labels: DataFrame, label: str, folds: int, held: int, bound: int
) -> DataFrame:
    """At most `bound` labelled ids outside the held-out fold, as (doc_id, label).

    The sample is the same on every run: the ids with the smallest hashes. An id that is
    labelled more than once gets the rounded mean. Its size is bounded, so it is broadcast.
    """
    given = labels.where(
        F.col("doc_id").isNotNull()
        & F.col(label).isNotNull()
        & (crc_fold(F.col("doc_id"), folds) != held)
    )
    ids = given.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    # The limit cuts off what the sample may have above the bound.
    return hash_sample(ids, bound, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def text_buffer(column: pa.Array, close: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, `close` after each, and the n + 1 offsets. Null is empty."""
    parts = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    texts = parts.to_pylist()
    sizes = np.fromiter((len(t) + len(close) for t in texts), np.int64, len(texts))
    data = np.frombuffer(close.join(texts) + close, np.uint8) if texts else np.zeros(0, np.uint8)
    return data, np.concatenate(([0], np.cumsum(sizes)))


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a slice has at most `most_bytes` of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + most_bytes, "right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def words_of(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts of a buffer in which every text ends with a space byte.

    Returns the compact buffer (words, one space after each), the start and end of each
    word in it, the start of each word in `data`, and the first word of each text (n + 1).
    """
    inside = ~space[data]
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    keep = inside.copy()
    keep[end] = True
    compact = data[keep]
    sizes = end - begin
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    compact[starts + sizes] = 0x20
    return compact, starts, starts + sizes, begin, np.searchsorted(begin, offsets)


def tailed(data: np.ndarray) -> np.ndarray:
    """The buffer with eight zero bytes behind it, so that 8-byte lanes can be read anywhere."""
    return np.concatenate((data, np.zeros(8, np.uint8)))


def lanes(data: np.ndarray) -> np.ndarray:
    """The 8-byte little-endian word at every position of a tailed buffer."""
    return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))


#: The lowest n bytes of a lane.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def append(
    docs: DataFrame,
    compute: Callable[[pa.Array], list[pa.Array]],
    fields: str,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """`keep` (all columns if not given) and what `compute` makes of each slice of texts."""
    ship(docs.sparkSession)
    kept = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    (read,) = unused(kept.columns, "__text")
    given = docs.select(
        *[docs[f"`{c}`"] for c in kept.columns], docs[f"`{text}`"].cast("string").alias(read)
    )
    schema = T.StructType([*kept.schema.fields, *T._parse_datatype_string(fields).fields])
    return given.mapInArrow(partial(_appended, compute, schema.names, read), schema)


def _appended(
    compute: Callable[[pa.Array], list[pa.Array]],
    names: list[str],
    read: str,
    batches: Iterator[pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, read):
        made = compute(batch.column(read))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names)
