"""Substring deduplication by a logarithmic family of suffix arrays.

Every byte covered by a `LENGTH`-byte string that also starts anywhere else in the corpus is
removed. Texts are UTF-8 bytes, and strings are judged on the input.

How the windows (strings of LENGTH bytes) meet. A window's key is the smallest hash of the
32-byte grams in it, so equal windows have equal keys wherever they stand. Neighbouring
windows mostly share their key: a run of them is a *segment*, the bytes its windows cover.
Only counts of keys and digests of segments are shuffled first:

1. A key that occurs once, in a segment where its gram stands once, has no repeated window:
   done, and that is most of them.
2. A segment that occurs again with the same bytes (128-bit digest) is repeated as a whole.
3. Keys with different segments, and segments that may repeat within themselves, go, one
   copy of each segment, to the index family of a shard. Its batches get suffix arrays (over
   window starts, to a depth of LENGTH), are merge-scanned against the existing levels for
   matches of LENGTH bytes, and levels of equal size merge into the next, so a window is merged
   a logarithmic number of times.
4. A key whose segments outgrow one shard (`HOT_BYTES`: a passage in very many documents,
   with a different neighbourhood in each) is split by content. Equal windows lie equally far
   before the first gram that has their key, so windows are cut into pieces of up to
   `WIDTHS[0]` such distances, and the bytes that all windows of a piece share (its *core*)
   name its group: equal windows are in one group. Steps 1 to 3 are then taken with groups
   for keys. A group that still outgrows a shard is cut into narrower pieces; in the last step
   a piece is one window, its core is the whole of it, and a group holds nothing else.

Steps 1 and 2 collapse copies before any text moves, so a hot group sends one row per task.
The removed stretches then go back to their documents by an equi-join.

Null texts are empty texts, and texts shorter than LENGTH have nothing to remove. Rows that
repeat are documents of their own, so their long texts are repeated strings. A null id keeps
its row. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import durable, ship, slices

LENGTH = 400
GRAM = 32
#: Bytes of segments that one shard's family is meant for, and that one key may bring to one.
SHARD_BYTES = 2 << 20
HOT_BYTES = 1 << 20
#: Windows of a piece of a key (then of a group) that brings more.
WIDTHS = (32, 1)
#: Bytes of a batch that gets its own suffix array.
BATCH_BYTES = 1 << 19


# --- segments -------------------------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes at every place."""
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        span = 1
        while span < GRAM:
            factor = np.uint64(pow(0xD6E8FEB86659FD93, span, 1 << 64))
            h = h[:-span] * factor + h[span:]
            span *= 2
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of `width` neighbours, from every place that has so many."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def twin_windows(hashes: np.ndarray, smallest: np.ndarray, width: int) -> np.ndarray:
    """Places of windows near two grams that share a smallest hash.

    A window that starts twice in one segment brings its smallest gram with it, so a segment
    without such a place repeats nothing within itself.
    """
    # A gram is the smallest of some window if no window around it has only smaller ones.
    around = np.full(len(smallest) + 2 * width - 2, np.iinfo(np.uint64).max)
    around[width - 1 : width - 1 + len(smallest)] = ~smallest
    anchors = np.flatnonzero(hashes[: len(smallest) + width - 1] == ~sliding_min(around, width))
    same = hashes[anchors[1:]] == hashes[anchors[:-1]]
    left, right = anchors[:-1][same], anchors[1:][same]
    near = right - left <= width
    change = np.zeros(len(smallest) + 2, np.int32)
    np.add.at(change, np.clip(right[near] - width, 0, len(smallest)), 1)
    np.add.at(change, np.clip(left[near] + 2, 0, len(smallest) + 1), -1)
    return np.cumsum(change)[: len(smallest)] > 0


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Runs of windows with one key: (text, first start, windows, key, twin).

    Starts are places in `data`; every text ends with one closing byte that is not its own.
    `twin` is true where a segment may repeat within itself.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length + 1:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    hashes = gram_hashes(data)
    key = sliding_min(hashes, length - GRAM + 1)
    twins = twin_windows(hashes, key, length - GRAM + 1)
    sizes = np.diff(offsets) - 1
    windows = np.maximum(sizes - length + 1, 0)
    doc = np.repeat(np.arange(len(windows)), windows)
    before = np.cumsum(windows) - windows
    start = np.arange(len(doc)) - before[doc] + offsets[:-1][doc]
    own = key[start]
    new = np.ones(len(doc), bool)
    new[1:] = (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    runs = np.diff(np.concatenate((first, [len(doc)])))
    twin = np.logical_or.reduceat(twins[start], first) if len(first) else none.astype(bool)
    return doc[first], start[first], runs, own[first], twin


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _halves(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


SEGMENT = "start int, windows int, key bigint, twin boolean, da bigint, db bigint"


#: Bytes of a text that are handled together; pieces of a longer text overlap by a window.
PIECE_BYTES = 1 << 20


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, int, bytes]]:
    """(row, first byte, bytes) of texts, long ones in pieces; each window is in one piece."""
    for row, text in enumerate(texts):
        data = (text or "").encode()
        for start in range(0, max(len(data) - LENGTH + 1, 0), PIECE_BYTES):
            yield row, start, data[start : start + PIECE_BYTES + LENGTH - 1]


def _segments_of(texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start, windows, key, twin, da, db) of all segments, some pieces at a time."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for piece in [*_pieces(texts), None]:
        if held and (piece is None or size + len(piece[2]) > PIECE_BYTES):
            rows, firsts, parts = zip(*held)
            closed = b"\n".join(parts) + b"\n"
            data = np.frombuffer(closed, np.uint8)
            offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])
            part, start, runs, key, twin = segments(data, offsets)
            ends = (start + runs + LENGTH - 1).tolist()
            da, db = _halves([_digest(closed[x:y]) for x, y in zip(start.tolist(), ends)])
            places = start - offsets[part] + np.array(firsts)[part]
            yield np.array(rows)[part], places, runs, key, twin, da, db
            held, size = [], 0
        if piece:
            held.append(piece)
            size += len(piece[2])


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", PIECE_BYTES):
        for row, start, runs, key, twin, da, db in _segments_of(batch.column("text").to_pylist()):
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(rows),
                    batch.column("th").take(rows),
                    pa.array(start.astype(np.int32)),
                    pa.array(runs.astype(np.int32)),
                    pa.array(key.view(np.int64)),
                    pa.array(twin),
                    pa.array(da),
                    pa.array(db),
                ],
                ["id", "th", "start", "windows", "key", "twin", "da", "db"],
            )


# --- the index family -------------------------------------------------------------------------


class Family:
    """Levels of suffix arrays over one growing buffer of segments.

    `repeated` tells for every place of the buffer whether the window that starts there
    also starts elsewhere.
    """

    def __init__(self, length: int = LENGTH) -> None:
        self.length = length
        self.buffer = np.zeros(1 << 16, np.uint8)
        self.repeated = np.zeros(1 << 16, bool)
        self.size = 0
        #: Window starts in the order of their windows, largest level first.
        self.levels: list[np.ndarray] = []

    def _append(self, data: bytes) -> int:
        begin, need = self.size, self.size + len(data) + self.length + 8
        if need > len(self.buffer):
            for name in ("buffer", "repeated"):
                old = getattr(self, name)
                new = np.zeros(max(need, 2 * len(old)), old.dtype)
                new[: self.size] = old[: self.size]
                setattr(self, name, new)
        self.buffer[begin : begin + len(data)] = np.frombuffer(data, np.uint8)
        self.size += len(data)
        return begin

    def add(self, parts: list[bytes]) -> list[int]:
        """Index a batch of segments; returns where each begins in the buffer."""
        begins = [self._append(p) for p in parts]
        starts = np.concatenate(
            [
                np.arange(b, b + max(len(p) - self.length + 1, 0))
                for b, p in zip(begins, parts)
            ]
            or [np.zeros(0, np.int64)]
        )
        if not len(starts):
            return begins
        order, same = self._sorted(starts, begins[0])
        self._mark(order[:-1][same], order[1:][same])
        for level in self.levels:
            self._merge_scan(level, order)
        while self.levels and len(self.levels[-1]) <= 2 * len(order):
            order = self._merged(self.levels.pop(), order)
        self.levels.append(order)
        return begins

    def _mark(self, a: np.ndarray, b: np.ndarray) -> None:
        self.repeated[a] = True
        self.repeated[b] = True

    def _lanes(self) -> np.ndarray:
        return np.ndarray((len(self.buffer) - 7,), ">u8", self.buffer, strides=(1,))

    def _sorted(self, starts: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts in the order of their windows, and which neighbours are equal.

        Prefix doubling: ranks by 8 bytes, then by 16, and so on; the last step overlaps so
        that exactly `length` bytes count.
        """
        span = min(8, self.length)
        lane = self._lanes()[base : self.size].astype(np.uint64)
        if span < 8:
            lane >>= np.uint64(8 * (8 - span))
        rank = np.unique(lane, return_inverse=True)[1].astype(np.int64)
        while span < self.length:
            step = min(span, self.length - span)
            after = np.zeros_like(rank)
            after[:-step] = rank[step:]
            rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1]
            span += step
        own = rank[starts - base]
        order = np.argsort(own, kind="stable")
        return starts[order], own[order][1:] == own[order][:-1]

    def _compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the window at `a` is before, equal to or behind that at `b`."""
        lanes, out = self._lanes(), np.zeros(len(a), np.int8)
        open_ = np.arange(len(a))
        for at in range(0, self.length, 8):
            at = min(at, max(self.length - 8, 0))
            x, y = lanes[a[open_] + at].astype(np.uint64), lanes[b[open_] + at].astype(np.uint64)
            if self.length < 8:
                x, y = (v >> np.uint64(8 * (8 - self.length)) for v in (x, y))
            out[open_] = (x > y).astype(np.int8) - (x < y)
            open_ = open_[x == y]
            if not len(open_):
                break
        return out

    def _places(self, level: np.ndarray, order: np.ndarray) -> np.ndarray:
        """For each window of `order` how many of `level` come before it."""
        lanes = self._lanes()
        heads, own = lanes[level].astype(np.uint64), lanes[order].astype(np.uint64)
        if self.length < 8:
            low, high = np.zeros(len(order), np.int64), np.full(len(order), len(level))
        else:  # the first eight bytes narrow the search at once
            low = np.searchsorted(heads, own, "left")
            high = np.searchsorted(heads, own, "right")
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            before = self._compare(level[middle], order[open_]) < 0
            low[open_[before]] = middle[before] + 1
            high[open_[~before]] = middle[~before]
            open_ = open_[low[open_] < high[open_]]
        return low

    def _merge_scan(self, level: np.ndarray, order: np.ndarray) -> None:
        """Mark windows that two sorted lists share: equal ones meet at the place."""
        place = self._places(level, order)
        inside = np.flatnonzero(place < len(level))
        here, there = order[inside], level[place[inside]]
        equal = self._compare(here, there) == 0
        self._mark(here[equal], there[equal])
        # The level's other copies of these windows were marked when they met each other.

    def _merged(self, level: np.ndarray, order: np.ndarray) -> np.ndarray:
        place = self._places(level, order) + np.arange(len(order))
        out = np.empty(len(level) + len(order), np.int64)
        taken = np.zeros(len(out), bool)
        taken[place] = True
        out[place], out[~taken] = order, level
        return out


def repeated_runs(parts: list[bytes], length: int = LENGTH, batch: int = BATCH_BYTES) -> list[list[tuple[int, int]]]:
    """For each segment the runs (first, one past the last) of repeated window starts."""
    family, begins, held, size = Family(length), [], [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= batch:
            begins += family.add(held)
            held, size = [], 0
    begins += family.add(held) if held else []
    return [
        runs_of(family.repeated[b : b + max(len(p) - length + 1, 0)]) for b, p in zip(begins, parts)
    ]


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


RUNS = "key bigint, da bigint, db bigint, runs array<struct<a: int, b: int>>"


def _shard_runs(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["key", "da", "db"])
    found = repeated_runs([bytes(x) for x in frame["bytes"]])
    out = frame[["key", "da", "db"]].copy()
    out["runs"] = [[{"a": a, "b": b} for a, b in runs] for runs in found]
    return out


# --- the plan -----------------------------------------------------------------------------------


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """What names a row: its id, and a hash that tells rows with one id apart."""
    return [
        F.coalesce(doc_id.cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(doc_id.isNull(), text).alias("th"),
    ]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments that a document lends to the index."""
    names = ["key", "da", "db", "hot", "bytes"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    for batch in slices(batches, "text"):
        rows = []
        for text, lent in zip(batch.column("text").to_pylist(), batch.column("lent").to_pylist()):
            data = text.encode()
            for s in lent:
                end = s["start"] + s["windows"] + LENGTH - 1
                rows.append((s["key"], s["da"], s["db"], s["hot"], data[s["start"] : end]))
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pieces_of(data: bytes, key: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of a segment: first window, number, and where their core begins.

    A window's distance is that to the first gram in it whose hash is the key. The windows of
    a run have one such gram, and distances of one block of `width`; the core are the bytes
    that every window of the block has (LENGTH - width + 1).
    """
    count = len(data) - LENGTH + 1
    grams = np.flatnonzero(gram_hashes(np.frombuffer(data, np.uint8)) == np.uint64(key))
    window = np.arange(count)
    gram = grams[np.searchsorted(grams, window)]
    block = (gram - window) // width
    new = np.ones(count, bool)
    new[1:] = (gram[1:] != gram[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, count)), (gram - block * width)[first]


PIECE = (
    "key bigint, da bigint, db bigint, places array<int>, windows int, core bigint, pa bigint, "
    "pb bigint, piece binary"
)


def _split(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of segments, each once with all its `places` in the segment.

    `piece` has the bytes where a slice has them for the first time.
    """
    kinds = [pa.list_(pa.int32()), pa.int32(), *[pa.int64()] * 3, pa.binary()]
    for batch in slices(batches, "bytes", 1 << 16):
        of, seen, cores, digests = [], set(), [], []
        places, sizes, given = [], [], []
        keys = batch.column("key").to_numpy().view(np.uint64)
        for i, data in enumerate(batch.column("bytes").to_pylist()):
            first, runs, core = pieces_of(data, keys[i], width)
            own: dict[bytes, list[int]] = {}
            for a, n, c in zip(first.tolist(), runs.tolist(), core.tolist()):
                piece = data[a : a + n + LENGTH - 1]
                digest = _digest(piece)
                if digest in own:
                    own[digest].append(a)
                    continue
                own[digest] = [a]
                of.append(i)
                places.append(own[digest])
                sizes.append(n)
                cores.append(_digest(data[c : c + LENGTH - width + 1]))
                digests.append(digest)
                given.append(None if digest in seen else piece)
                seen.add(digest)
        columns = [places, sizes, _halves(cores)[0], *_halves(digests), given]
        rows = pa.array(of, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c).take(rows) for c in ("key", "da", "db")),
                *(pa.array(c, k) for c, k in zip(columns, kinds)),
            ],
            ["key", "da", "db", "places", "windows", "core", "pa", "pb", "piece"],
        )


def _copies(pieces: DataFrame) -> DataFrame:
    """Distinct pieces (key, core, da, db), their number and bytes."""
    return (
        pieces.groupBy("key", "core", "pa", "pb")
        .agg(F.sum(F.size("places")).alias("n"), F.max("piece").alias("bytes"))
        .toDF("key", "core", "da", "db", "n", "bytes")
    )


def _by_family(parts: DataFrame, group: str, size: int) -> DataFrame:
    """Repeated runs of parts (key, da, db, bytes), those of a group in one index family."""
    shards = max(1, -(-size // SHARD_BYTES))
    return (
        parts.withColumn("shard", F.pmod(F.xxhash64(group), F.lit(shards)))
        .select("shard", "key", "da", "db", "bytes")
        .groupBy("shard")
        .applyInPandas(_shard_runs, RUNS)
    )


def _sizes(weight: DataFrame, size: str, most: int | None) -> tuple[int, int]:
    """Bytes of all groups of at most `most` (if given), and of the largest group."""
    small = F.lit(True) if most is None else F.col(size) <= most
    total, largest = weight.agg(F.sum(F.when(small, F.col(size))), F.max(size)).first()
    return total or 0, largest or 0


def _split_runs(hot: DataFrame, widths: tuple[int, ...]) -> DataFrame:
    """Repeated runs of segments (key, da, db, bytes) whose keys are too large for one shard."""
    pieces = hot.mapInArrow(partial(_split, widths[0]), PIECE)
    groups = durable(
        pieces.groupBy("key", "core")
        .agg(
            F.sum(F.size("places")).alias("n"),
            ((F.min("pa") < F.max("pa")) | (F.min("pb") < F.max("pb"))).alias("differ"),
        )
        .where("n > 1")
        .drop("n")
    )
    # Copies are counted before the join, which gives a group to one task: a group may hold most
    # of the pieces, but copies of a piece leave a task as one row.
    in_mixed = groups.where("differ").drop("differ")
    distinct = durable(_copies(pieces).join(in_mixed, ["key", "core"]))
    weight = durable(distinct.groupBy("key", "core").agg(F.sum(F.length("bytes")).alias("size")))
    most = HOT_BYTES if len(widths) > 1 else None
    total, largest = _sizes(weight, "size", most)
    sized = distinct.join(weight, ["key", "core"])
    whole = F.struct(F.lit(0).alias("a"), (F.length("bytes") - F.lit(LENGTH - 1)).alias("b"))
    runs = distinct.where("n > 1").select("key", "da", "db", F.array(whole).alias("runs"))
    if most is None or largest <= most:
        runs = runs.union(_by_family(sized, "core", total))
    else:
        runs = runs.union(_by_family(sized.where(F.col("size") <= most), "core", total))
        # Dealt anew, as a group may lie in one task, and kept, as they are cut more than once.
        over = sized.where(F.col("size") > most).select("key", "da", "db", "bytes")
        over = durable(over.repartition("key", "da", "db"))
        runs = runs.union(_split_runs(over, widths[1:]))
    runs = runs.where(F.size("runs") > 0).toDF("key", "pa", "pb", "runs")
    span = F.struct(F.lit(0).alias("a"), F.col("windows").alias("b"))
    named = pieces.drop("piece").join(groups, ["key", "core"])
    named = named.select("key", "da", "db", "places", "windows", "differ", "pa", "pb")
    judged = named.where("not differ").withColumn("runs", F.array(span)).union(
        named.where("differ").join(durable(runs), ["key", "pa", "pb"]).select(*named.columns, "runs")
    )
    return (
        judged.groupBy("key", "da", "db")
        .agg(F.collect_list(F.struct("places", "runs")).alias("found"))
        .mapInArrow(_joined_runs, RUNS)
    )


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a segment, those of its pieces at all their places, joined to maximal ones."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    for batch in batches:
        joined = []
        for row in batch.column("found"):
            found = row.as_py()
            ends = (max(x["places"]) + max(r["b"] for r in x["runs"]) for x in found)
            flags = np.zeros(max(ends), bool)
            for x in found:
                for place in x["places"]:
                    for r in x["runs"]:
                        flags[place + r["a"] : place + r["b"]] = True
            joined.append([{"a": a, "b": b} for a, b in runs_of(flags)])
        columns = [batch.column(c) for c in ("key", "da", "db")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(joined, kind)], ["key", "da", "db", "runs"]
        )


def stretches(docs: DataFrame) -> DataFrame:
    """Per document the stretches to remove: id, th, cuts (pairs of byte places).

    `docs` has id, th and text. Stretches may overlap.
    """
    found = docs.mapInArrow(_segment_batches, f"id bigint, th bigint, {SEGMENT}")
    keys = durable(
        found.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            ((F.min("da") < F.max("da")) | (F.min("db") < F.max("db"))).alias("differ"),
            F.max("twin").alias("twin"),
        )
        .where("n > 1 or twin")
        .select("key", (F.col("differ") | (F.col("n") == 1)).alias("mixed"))
    )
    shared = durable(found.drop("twin").join(keys, "key"))
    distinct = (
        shared.where("mixed")
        .groupBy("key", "da", "db")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("id", "th", "start", "windows")).alias("owner"),
        )
    )
    distinct = durable(distinct.select("key", "da", "db", "n", "owner.*"))
    weight = durable(
        distinct.groupBy("key").agg(
            F.sum(F.col("windows") + F.lit(LENGTH - 1)).alias("key_bytes")
        )
    )
    total, largest = _sizes(weight, "key_bytes", HOT_BYTES)
    lent = (
        distinct.join(weight, "key")
        .withColumn("hot", F.col("key_bytes") > HOT_BYTES)
        .groupBy("id", "th")
        .agg(F.collect_set(F.struct("start", "windows", "key", "da", "db", "hot")).alias("lent"))
    )
    # A row that repeats lends its segments twice; one copy of each is indexed.
    parts = durable(
        docs.join(lent, ["id", "th"])
        .select("text", "lent")
        .mapInArrow(_cut, "key bigint, da bigint, db bigint, hot boolean, bytes binary")
        .dropDuplicates(["key", "da", "db"])
    )
    runs = _by_family(parts.where("not hot"), "key", total)
    if largest > HOT_BYTES:
        runs = runs.union(_split_runs(parts.where("hot").drop("hot"), WIDTHS))
    runs = durable(runs.where(F.size("runs") > 0))
    whole = durable(distinct.where("n > 1").select("key", "da", "db", F.lit(True).alias("whole")))
    judged = (
        shared.join(whole, ["key", "da", "db"], "left")
        .join(runs, ["key", "da", "db"], "left")
        .withColumn("whole", F.coalesce("whole", ~F.col("mixed")))
        .where(F.col("whole") | F.col("runs").isNotNull())
    )
    span = F.struct(F.lit(0).alias("a"), F.col("windows").alias("b"))
    each = F.when(F.col("whole"), F.array(span)).otherwise(F.col("runs"))
    return (
        judged.select("id", "th", "start", F.explode(each).alias("run"))
        .select(
            "id",
            "th",
            F.struct(
                (F.col("start") + F.col("run.a")).alias("a"),
                (F.col("start") + F.col("run.b") + F.lit(LENGTH - 1)).alias("b"),
            ).alias("cut"),
        )
        .groupBy("id", "th")
        .agg(F.collect_set("cut").alias("cuts"))
    )


def kept_bytes(data: bytes, cuts: list) -> tuple[bytes, int]:
    """The bytes outside of all cuts, and the number of maximal removed runs."""
    if not cuts:
        return data, 0
    gone = np.zeros(len(data) + 1, np.int32)
    np.add.at(gone, [c["a"] for c in cuts], 1)
    np.add.at(gone, [c["b"] for c in cuts], -1)
    removed = np.cumsum(gone[:-1]) > 0
    kept = np.frombuffer(data, np.uint8)[~removed].tobytes()
    return kept, len(runs_of(removed))


def with_cuts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row: doc_id, text and its `cuts`, the stretches of bytes to remove (or null)."""
    ship(docs.sparkSession)
    given = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    keyed = given.select("doc_id", *_row_key(F.col("doc_id"), F.col("text")), "text")
    cuts = stretches(keyed.drop("doc_id"))
    return keyed.join(cuts, ["id", "th"], "left").select("doc_id", "text", "cuts")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = []
        for text, cuts in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist()):
            data = text.encode()
            kept, spans = kept_bytes(data, cuts)
            rows.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    cut = with_cuts(docs, text, doc_id)
    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.mapInArrow(
        _report,
        f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )


def removed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id and the bytes that stay, as text; a character that was cut into is replaced."""

    def run(batches):
        for batch in slices(batches, "text"):
            kept = [
                kept_bytes(t.encode(), c)[0].decode("utf-8", "replace")
                for t, c in zip(batch.column("text").to_pylist(), batch.column("cuts").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.string())], ["doc_id", "text"])

    cut = with_cuts(docs, text, doc_id)
    kind = cut.schema["doc_id"].dataType.simpleString()
    return cut.mapInArrow(run, f"doc_id {kind}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/documents.parquet"))
