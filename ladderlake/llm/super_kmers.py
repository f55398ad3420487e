"""Substring deduplication of words: super-k-mers dealt out by minimiser, windows counted by sorting.

A window is `WINDOW` consecutive words of one document. Every word goes that is covered by a
window whose words also start in a document with a smaller id; windows are judged on the input.

A window's minimiser is the least hash of the `GRAM`-word grams in it, so equal windows have
equal minimisers wherever they stand, and neighbouring windows mostly share theirs. Such a run
of windows is a super-k-mer: it travels as one packed string, its words with one space between,
to the bucket of its minimiser. There the words become numbers, and windows are ranked by
sorting pairs of ranks of half their length, which tells equal windows from different ones
exactly; each class keeps the least id that holds it.

Before any text moves, only digests and counts of super-k-mers are shuffled: a minimiser that
occurs in one document has no window to remove, and of super-k-mers with equal strings one
travels, lent by the document with the least id, so a group of copies sends one string. The
least ids of its windows then go back to all documents that hold the string, by an equi-join
on its digest, and the stretches to their documents.

A minimiser may be in very many documents, each with other words around it. One of more than
`HOT_WINDOWS` windows would be too much for one task, so its super-k-mers are unpacked where
they are cut out, and Spark groups the windows by all their words, with a map-side combine.
Runs of more than `MOST_WINDOWS` windows (a text of one repeated word) are several super-k-mers.

Null texts are empty texts. A document with fewer words than a window loses none. Rows with
one id are one document here: none of them has a smaller id than the others. A row without an
id is neither before nor after any other; it stays whole. An empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import SPACE, durable, ship, slices, tailed, text_buffer, words_of
from ladderlake.llm.simhash import xxh64
from ladderlake.llm.suffix_dedup import sliding_min

WINDOW = 50
#: Words of a gram; a power of two.
GRAM = 8
#: Windows of a super-k-mer, and of the super-k-mers that one minimiser may bring to a bucket.
MOST_WINDOWS = 256
HOT_WINDOWS = 1 << 17
#: Bytes of a text that are handled together; pieces of a longer text overlap by a window.
PIECE_BYTES = 1 << 20


# --- super-k-mers of a text -------------------------------------------------------------------


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of the GRAM words at every place, from the hashes of words."""
    with np.errstate(over="ignore"):
        h, span = words, 1
        while span < GRAM:
            factor = np.uint64(pow(0xD6E8FEB86659FD93, span, 1 << 64))
            h = h[:-span] * factor + h[span:]
            span *= 2
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def runs_of_windows(
    hashes: np.ndarray, first: np.ndarray, window: int = WINDOW
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: (text, first word, windows, minimiser).

    `hashes` are those of the words of all texts, `first` the first word of each (n + 1).
    """
    count = np.maximum(np.diff(first) - window + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    if not len(text):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    start = np.arange(len(text)) - (np.cumsum(count) - count)[text] + first[:-1][text]
    least = sliding_min(gram_hashes(hashes), window - GRAM + 1)[start]
    new = np.ones(len(text), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.concatenate((head, [len(text)])))
    parts = -(-size // MOST_WINDOWS)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    head = np.repeat(head, parts) + nth * MOST_WINDOWS
    size = np.minimum(np.repeat(size, parts) - nth * MOST_WINDOWS, MOST_WINDOWS)
    return text[head], start[head], size, least[head]


def pieces(text: str | None, window: int = WINDOW) -> Iterator[tuple[int, bytes]]:
    """The text in pieces that hold all its windows: (number of words before it, bytes)."""
    data = (text or "").encode()
    at, before, size = 0, 0, PIECE_BYTES
    while True:
        stop = at + size
        while stop < len(data) and not SPACE[data[stop]]:
            stop += 1
        piece = data[at:stop]
        if stop >= len(data):
            yield before, piece
            return
        words = np.flatnonzero(np.diff(SPACE[np.frombuffer(b" " + piece, np.uint8)].view(np.int8)) == -1)
        if len(words) < window:
            size *= 2
            continue
        yield before, piece
        before += len(words) - window + 1
        at, size = at + int(words[len(words) - window + 1]), PIECE_BYTES


FOUND = "start bigint, windows int, key bigint, da bigint, db bigint"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of documents: where they start, their minimiser and their string's digest."""
    for batch in slices(batches, "text"):
        texts = batch.column("text").to_pylist()
        if max(map(len, texts)) <= PIECE_BYTES // 4:
            parts = [(i, 0, text) for i, text in enumerate(texts)]
        else:
            parts = [(i, b, p.decode()) for i, t in enumerate(texts) for b, p in pieces(t)]
        at = 0
        while at < len(parts):
            stop, size = at, 0
            while stop < len(parts) and (stop == at or size + len(parts[stop][2]) <= 2 * PIECE_BYTES):
                size += len(parts[stop][2])
                stop += 1
            of, before, some = zip(*parts[at:stop])
            at = stop
            data, offsets = text_buffer(pa.array(some, pa.large_string()))
            compact, begin, end, _, first = words_of(data, offsets, SPACE)
            hashes = xxh64(tailed(compact), begin, end)
            text, start, windows, key = runs_of_windows(hashes, first)
            if not len(text):
                continue
            view = compact.tobytes()
            lo, hi = begin[start].tolist(), end[start + windows + WINDOW - 2].tolist()
            digests = b"".join(
                hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(lo, hi)
            )
            both = np.frombuffer(digests, "<i8").reshape(-1, 2)
            row = np.asarray(of)[text]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(row)) for c in ("id", "th")),
                    pa.array(start - first[:-1][text] + np.asarray(before)[text], pa.int64()),
                    pa.array(windows, pa.int32()),
                    pa.array(key.view(np.int64)),
                    pa.array(both[:, 0].copy()),
                    pa.array(both[:, 1].copy()),
                ],
                ["id", "th", "start", "windows", "key", "da", "db"],
            )


# --- windows of a bucket ------------------------------------------------------------------------


def least_ids(strings: pa.Array, ids: np.ndarray, window: int = WINDOW):
    """For every window of the packed strings the least id of a string that holds it.

    Returns the ids, one per window, and the first window of each string (n + 1).
    """
    words = pc.split_pattern(strings, " ")
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    count = np.maximum(sizes - window + 1, 0)
    first = np.concatenate(([0], np.cumsum(count)))
    if not first[-1]:
        return np.zeros(0, np.int64), first
    of = np.repeat(np.arange(len(count)), count)
    start = np.arange(first[-1]) - first[of] + (np.cumsum(sizes) - sizes)[of]
    rank = words.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
    span = 1
    while 2 * span <= window:
        rank = _ranked(rank[:-span], rank[span:])
        span *= 2
    kinds = _ranked(rank[start], rank[start + window - span])
    order = np.lexsort((ids[of], kinds))
    sorted_kinds = kinds[order]
    new = np.concatenate(([True], sorted_kinds[1:] != sorted_kinds[:-1]))
    least = np.empty(len(kinds), np.int64)
    least[order] = ids[of][order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    return least, first


def _ranked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks, equal for equal pairs only."""
    pairs = left * (int(right.max()) + 1) + right
    return np.unique(pairs, return_inverse=True)[1].astype(np.int64)


RUNS = "key bigint, da bigint, db bigint, runs array<struct<a: int, b: int, least: bigint>>"
_RUN = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("least", pa.int64())]))


def _runs(least: np.ndarray) -> list[dict]:
    """Neighbouring windows with one least id."""
    edges = np.flatnonzero(np.diff(least)) + 1
    bounds = [0, *edges.tolist(), len(least)]
    return [{"a": a, "b": b, "least": int(least[a])} for a, b in zip(bounds, bounds[1:])]


def _judged(rows: pa.Table) -> pa.RecordBatch:
    """Runs of the super-k-mers of whole buckets, where a document may lose words by them."""
    rows = rows.combine_chunks()
    ids = rows.column("id").to_numpy()
    lasts = rows.column("last").to_numpy()
    least, first = least_ids(rows.column("words").combine_chunks().cast(pa.large_string()), ids)
    runs = []
    for i in range(len(ids)):
        own = least[first[i] : first[i + 1]]
        runs.append(_runs(own) if len(own) and own.min() < lasts[i] else None)
    names = ["key", "da", "db"]
    columns = [rows.column(c).combine_chunks() for c in names]
    out = pa.RecordBatch.from_arrays([*columns, pa.array(runs, _RUN)], [*names, "runs"])
    return out.filter(pc.is_valid(out.column("runs")))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Judge the buckets of a partition, whose rows come in order of their key.

    Whole buckets are taken together until they have as many windows as a hot one.
    """
    held: list[pa.Table] = []
    count = 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        held.append(table)
        count += pc.sum(table.column("windows")).as_py()
        if count < HOT_WINDOWS:
            continue
        rows = pa.concat_tables(held)
        keys = rows.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left"))
        if cut:
            yield from _judged_in_parts(rows.slice(0, cut))
        held = [rows.slice(cut)]
        count = pc.sum(held[0].column("windows")).as_py()
    if held:
        yield from _judged_in_parts(pa.concat_tables(held))


def _judged_in_parts(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Judge whole buckets, a bounded number of windows at a time."""
    keys = rows.column("key").to_numpy()
    ends = np.concatenate((np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
    windows = np.cumsum(rows.column("windows").to_numpy())
    at = 0
    while at < len(keys):
        most = (windows[at - 1] if at else 0) + HOT_WINDOWS
        fits = ends[(ends > at) & (windows[ends - 1] <= most)]
        stop = int(fits[-1] if len(fits) else ends[ends > at][0])
        yield _judged(rows.slice(at, stop - at))
        at = stop


# --- the plan -----------------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed strings of the super-k-mers that a document lends to the buckets."""
    names = ["key", "da", "db", "id", "last", "hot", "windows", "words"]
    kinds = [*[pa.int64()] * 5, pa.bool_(), pa.int32(), pa.string()]
    for batch in slices(batches, "text"):
        data, offsets = text_buffer(batch.column("text"))
        compact, begin, end, _, first = words_of(data, offsets, SPACE)
        view = compact.tobytes()
        rows = []
        for i, lent in enumerate(batch.column("lent").to_pylist()):
            for s in lent:
                head = int(first[i]) + s["start"]
                words = view[begin[head] : end[head + s["windows"] + WINDOW - 2]]
                rows.append((*(s[c] for c in names[:3]), s["id"], *(s[c] for c in names[4:7]), words.decode()))
        columns = zip(*rows) if rows else [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a super-k-mer as a row of its own."""
    names = ["key", "da", "db", "id", "last"]
    for batch in slices(batches, "words", 1 << 17):
        rows, places, windows = [], [], []
        for i, text in enumerate(batch.column("words").to_pylist()):
            words = text.split(" ")
            for a in range(len(words) - WINDOW + 1):
                rows.append(i)
                places.append(a)
                windows.append(" ".join(words[a : a + WINDOW]))
        columns = [batch.column(c).take(pa.array(rows, pa.int32())) for c in names]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(places, pa.int32()), pa.array(windows, pa.string())],
            [*names, "place", "window"],
        )


def _window_runs(hot: DataFrame) -> DataFrame:
    """Runs of the super-k-mers whose minimiser is in too many windows for one bucket."""
    windows = hot.mapInArrow(
        _unpacked,
        "key bigint, da bigint, db bigint, id bigint, last bigint, place int, window string",
    )
    least = windows.groupBy("window").agg(F.min("id").alias("least"))
    return (
        windows.join(least, "window")
        .where(F.col("least") < F.col("last"))
        .groupBy("key", "da", "db")
        .agg(
            F.collect_list(
                F.struct(
                    F.col("place").alias("a"), (F.col("place") + F.lit(1)).alias("b"), "least"
                )
            ).alias("runs")
        )
    )


def stretches(docs: DataFrame) -> DataFrame:
    """Per document the words to remove: id, th, cuts (first word, and first one after them).

    `docs` has id, th and text. Stretches may overlap.
    """
    found = docs.mapInArrow(_found, f"id bigint, th bigint, {FOUND}")
    keys = durable(
        found.groupBy("key")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low < high")
        .select("key")
    )
    shared = durable(found.join(keys, "key"))
    distinct = durable(
        shared.groupBy("key", "da", "db").agg(
            F.max("id").alias("last"), F.min(F.struct("id", "th", "start", "windows")).alias("owner")
        )
    )
    # Stored, so that both sides of the join are plain and a hot key's part of it can be split.
    weights = durable(distinct.groupBy("key").agg(F.sum("owner.windows").alias("key_windows")))
    lent = (
        distinct.join(weights, "key")
        .withColumn("hot", F.col("key_windows") > HOT_WINDOWS)
        .select("key", "da", "db", "last", "hot", "owner.*")
        .groupBy("id", "th")
        .agg(F.collect_set(F.struct("start", "windows", "key", "da", "db", "id", "last", "hot")).alias("lent"))
    )
    # A row that repeats lends its super-k-mers twice; that changes no least id.
    parts = durable(
        docs.join(lent, ["id", "th"])
        .select("text", "lent")
        .mapInArrow(
            _cut,
            "key bigint, da bigint, db bigint, id bigint, last bigint, hot boolean, "
            "windows int, words string",
        )
    )
    bucketed = parts.where("not hot").repartition("key").sortWithinPartitions("key")
    runs = bucketed.mapInArrow(_buckets, RUNS).union(_window_runs(parts.where("hot")))
    run = F.col("run")
    return (
        shared.join(durable(runs).dropDuplicates(["key", "da", "db"]), ["key", "da", "db"])
        .select("id", "th", "start", F.explode("runs").alias("run"))
        .where(run["least"] < F.col("id"))
        .select(
            "id",
            "th",
            F.struct(
                (F.col("start") + run["a"]).alias("a"),
                (F.col("start") + run["b"] + F.lit(WINDOW - 1)).alias("b"),
            ).alias("cut"),
        )
        .groupBy("id", "th")
        .agg(F.collect_set("cut").alias("cuts"))
    )


def with_cuts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row: doc_id, text and its `cuts`, the stretches of words to remove (or null)."""
    ship(docs.sparkSession)
    given = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    keyed = given.select(
        "doc_id", F.col("doc_id").cast("bigint").alias("id"), F.xxhash64("text").alias("th"), "text"
    )
    cuts = stretches(keyed.where("id is not null").drop("doc_id"))
    return keyed.join(cuts, ["id", "th"], "left").select("doc_id", "text", "cuts")


def kept_words(texts: pa.Array, cuts: list) -> Iterator[tuple[int, int, bytes]]:
    """Per text its number of words, how many of them go, and the others, a space between."""
    data, offsets = text_buffer(texts)
    compact, begin, end, _, first = words_of(data, offsets, SPACE)
    change = np.zeros(len(begin) + 1, np.int32)
    for i, some in enumerate(cuts):
        if some:
            np.add.at(change, first[i] + np.fromiter((c["a"] for c in some), np.int64), 1)
            np.add.at(change, first[i] + np.fromiter((c["b"] for c in some), np.int64), -1)
    gone = np.cumsum(change[:-1]) > 0
    keep = np.repeat(~gone, end - begin + 1)
    left = compact[keep].tobytes()
    sizes = np.where(gone, 0, end - begin + 1)
    ends = np.concatenate(([0], np.cumsum(sizes)))[first]
    lost = np.concatenate(([0], np.cumsum(gone)))[first]
    for i in range(len(cuts)):
        yield (
            int(first[i + 1] - first[i]),
            int(lost[i + 1] - lost[i]),
            left[ends[i] : max(ends[i + 1] - 1, ends[i])],
        )


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = [
            (words, lost, hashlib.sha256(kept).hexdigest())
            for words, lost, kept in kept_words(batch.column("text"), batch.column("cuts").to_pylist())
        ]
        kinds = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    cut = with_cuts(docs, text, doc_id)
    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.mapInArrow(
        _report, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string"
    )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        kept = kept_words(batch.column("text"), batch.column("cuts").to_pylist())
        texts = pa.array([left.decode() for _, _, left in kept], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])


def removed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and text: the words that stay, one space between them."""
    cut = with_cuts(docs, text, doc_id)
    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.mapInArrow(_removed, f"doc_id {kind}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
