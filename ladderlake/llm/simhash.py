"""SimHash near-duplicates, linked by vantage-point trees.

Fingerprints: a document's 3-word shingles are hashed with XXH64; a bit is set where over
half of the hashes have it. The hashes of a slice of texts are computed together in numpy.

Links (at most `RADIUS` differing bits): distinct fingerprints are dealt to shards by a
vantage-point tree. At a node a fingerprint goes inside if its Hamming distance to the
vantage point is at most the node's bound, else outside. By the triangle inequality two
linked fingerprints differ by at most RADIUS in that distance, so one that lies outside by
no more than RADIUS visits the inner side as well. At every node the two of a linked pair
then share a side, hence some shard holds both, and no pair is missed. The routing tree is
grown on a bounded sample (`SAMPLE_ROWS`); it decides only where work is done. Inside a
shard the same splitting goes on until blocks are small enough to be compared outright.

A shard returns its spanning links (a fingerprint and its component's smallest member),
never all pairs, so its output is no larger than its input. The links of all shards are
joined into components by large-star/small-star rounds over distinct fingerprints.

Null texts are empty texts; without a word the fingerprint is zero and links like any
other. A null id keeps its row; it is ignored for `component_id` unless the component has
no other id. Repeated rows and equal texts share a fingerprint. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import (
    LOWER,
    SPACE,
    durable,
    hash_sample,
    one_of_each,
    ship,
    slices,
    text_buffer,
    words_of,
)

RADIUS = 2
SHINGLE_WORDS = 3
#: Fingerprints that the routing tree is grown on, and how many of a sample make a shard.
SAMPLE_ROWS = 65_536
SHARD_ROWS = 4_096
#: Blocks up to this many fingerprints are compared outright.
BLOCK_ROWS = 512

# XXH64's primes (fixed values).
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)
SEED = 42


def _rotl(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """XXH64 (seed 42) of data[start:end] for each pair. `data` is 8 bytes longer than used."""
    size = end - start
    with np.errstate(over="ignore"):
        h = np.uint64(SEED) + P5 + size.astype(np.uint64)
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        four = np.ndarray((len(data) - 7,), "<u4", data, strides=(1,))
        at = start.copy()
        for step in range(3):
            on = np.flatnonzero((size >= 8 * (step + 1)) & (size < 32))
            lane = _rotl(eight[at[on]] * P2, 31) * P1
            h[on] = _rotl(h[on] ^ lane, 27) * P1 + P4
            at[on] += 8
        on = np.flatnonzero(((size & 4) > 0) & (size < 32))
        h[on] = _rotl(h[on] ^ (four[at[on]].astype(np.uint64) * P1), 23) * P2 + P3
        at[on] += 4
        for step in range(3):
            on = np.flatnonzero(((size & 3) > step) & (size < 32))
            h[on] = _rotl(h[on] ^ (data[at[on]].astype(np.uint64) * P5), 11) * P1
            at[on] += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        h = h ^ (h >> np.uint64(32))
    view = data.data
    for i in np.flatnonzero(size >= 32):
        h[i] = xxhash.xxh64_intdigest(view[start[i] : end[i]], SEED)
    return h


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    data, offsets = text_buffer(texts)
    compact, start, end, _, first = words_of(LOWER[data], offsets, SPACE)
    compact = np.concatenate((compact, np.zeros(8, np.uint8)))
    count = np.diff(first)
    shingles = np.where(count > 0, np.maximum(count - SHINGLE_WORDS + 1, 1), 0)
    doc = np.repeat(np.arange(len(count)), shingles)
    if not len(doc):
        return np.zeros(len(count), np.uint64)
    bounds = np.concatenate(([0], np.cumsum(shingles)))
    head = first[:-1][doc] + np.arange(len(doc)) - bounds[:-1][doc]
    last = np.minimum(head + SHINGLE_WORDS - 1, first[1:][doc] - 1)
    hashes = xxh64(compact, start[head], end[last])
    out = np.zeros(len(count), np.uint64)
    some = np.flatnonzero(shingles)
    for bit in range(64):
        ones = ((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32)
        over = 2 * np.add.reduceat(ones, bounds[some]) > shingles[some]
        out[some[over]] |= np.uint64(1) << np.uint64(bit)
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        prints = pa.array(fingerprints(batch.column("text")).view(np.int64))
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), prints], [*kept, "fp"])


def with_fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", key: Column | None = None
) -> DataFrame:
    """doc_id, the key if one is given, and fp (the fingerprint as a signed bigint) of every
    document."""
    ship(docs.sparkSession)
    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        *([] if key is None else [key.alias("key")]),
        F.col(text).cast("string").alias("text"),
    )
    fields = "doc_id bigint, fp bigint" if key is None else "doc_id bigint, key string, fp bigint"
    return narrow.mapInArrow(_fingerprint_batches, fields)


# --- the vantage-point tree ---------------------------------------------------------------


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def best_split(points: np.ndarray, radius: int, seed: int) -> tuple[np.uint64, int] | None:
    """The vantage point and bound that part `points` with the fewest visitors.

    Several points are tried as vantage points, and every bound; a split is better the
    smaller its larger side gets, visitors included. None if no split shrinks both sides.
    """
    rng = np.random.default_rng(seed)
    seen = points if len(points) <= 2_048 else rng.choice(points, 2_048, replace=False)
    best, least = None, 0.9 * len(seen)
    for v in rng.choice(points, min(12, len(points)), replace=False):
        counts = np.cumsum(np.bincount(_distance(seen, v), minlength=65 + radius))
        inner = counts[radius : 65 + radius]
        larger = np.maximum(inner, len(seen) - counts[:65])
        cost = larger + 0.5 * (inner - counts[:65])
        at = int(np.argmin(np.where(larger < 0.9 * len(seen), cost, np.inf)))
        if larger[at] < 0.9 * len(seen) and cost[at] < least:
            best, least = (v, at), cost[at]
    return best


def grow(points: np.ndarray, leaf: int, radius: int = RADIUS) -> list[tuple[int, int, int, int]]:
    """A routing tree: nodes (vantage point, bound, inner child, outer child).

    A child that is negative is the shard -child - 1.
    """
    nodes: list[list] = []
    shards = 0
    work = [(points, None, 0)]
    while work:
        here, parent, side = work.pop()
        split = best_split(here, radius, len(nodes)) if len(here) > leaf else None
        if split is None:
            shards += 1
            if parent is not None:
                nodes[parent][side] = -shards
            continue
        if parent is not None:
            nodes[parent][side] = len(nodes)
        nodes.append([int(split[0]), int(split[1]), 0, 0])
        distance = _distance(here, split[0])
        own = len(nodes) - 1
        work.append((here[distance <= split[1] + radius], own, 2))
        work.append((here[distance > split[1]], own, 3))
    return [tuple(n) for n in nodes]


def route(points: np.ndarray, nodes: list, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(position in `points`, shard) of every visit; boundary points visit several shards."""
    if not nodes:
        return np.arange(len(points)), np.zeros(len(points), np.int64)
    where, shard = [], []
    work = [(np.arange(len(points)), 0)]
    while work:
        rows, node = work.pop()
        if node < 0:
            where.append(rows)
            shard.append(np.full(len(rows), -node - 1))
        elif len(rows):
            vantage, bound, inner, outer = nodes[node]
            distance = _distance(points[rows], np.uint64(vantage))
            work.append((rows[distance <= bound + radius], inner))
            work.append((rows[distance > bound], outer))
    return np.concatenate(where or [np.zeros(0, int)]), np.concatenate(shard or [np.zeros(0, int)])


def pairs_within(
    points: np.ndarray, radius: int = RADIUS, block: int = BLOCK_ROWS
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs of `points` at most `radius` apart, block by block.

    Pairs may come more than once.
    """
    work = [np.arange(len(points))]
    while work:
        rows = work.pop()
        split = best_split(points[rows], radius, len(rows)) if len(rows) > block else None
        if split is not None:
            distance = _distance(points[rows], split[0])
            work.append(rows[distance <= split[1] + radius])
            work.append(rows[distance > split[1]])
            continue
        here = points[rows]
        for start in range(0, len(rows), block):
            near = np.bitwise_count(here[start : start + block, None] ^ here[None, start:]) <= radius
            left, right = np.nonzero(near)
            off = left < right
            yield rows[left[off] + start], rows[right[off] + start]


def smallest_linked(points: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each point the smallest point of its component under links of `radius`."""
    root = np.arange(len(points))

    def top(x: np.ndarray) -> np.ndarray:
        while (root[x] != x).any():
            x = root[x]
        return x

    for left, right in pairs_within(points, radius):
        a, b = top(left), top(right)
        while (open_ := a != b).any():
            low, high = np.minimum(a, b)[open_], np.maximum(a, b)[open_]
            np.minimum.at(root, high, low)
            a, b = top(a), top(b)
    flat = top(np.arange(len(points)))
    return points[flat]


def _routed(nodes: list, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy().view(np.uint64)
        rows, shard = route(prints, nodes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard, pa.int64()), pa.array(prints[rows].view(np.int64))], ["shard", "fp"]
        )


def _shard_links(frame: pd.DataFrame) -> pd.DataFrame:
    prints = np.unique(frame["fp"].to_numpy()).view(np.uint64)
    root = smallest_linked(prints)
    on = root != prints
    return pd.DataFrame({"a": prints[on].view(np.int64), "b": root[on].view(np.int64)})


def spanning_links(distinct: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Links (a, b) that span the components of the distinct fingerprints `fp`."""
    drawn = hash_sample(distinct, sample_rows, "fp").toPandas()["fp"].to_numpy(np.int64)
    leaf = max(32, int(SHARD_ROWS * min(1.0, len(drawn) / max(distinct.count(), 1))))
    nodes = grow(np.sort(drawn).view(np.uint64), leaf)
    visits = distinct.mapInArrow(partial(_routed, nodes), "shard bigint, fp bigint")
    return visits.groupBy("shard").applyInPandas(_shard_links, "a bigint, b bigint")


# --- components -----------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that links touch; root is the smallest of its component.

    Alternates large-star and small-star rounds until nothing changes. Each round is one
    aggregate with a map-side combine and one join; rounds are cut by a checkpoint.
    """
    edges = durable(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join below reads it through an exchange of its own and adaptive
        # execution can split a node with very many links.
        least = durable(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lower, "u")
            .where("v <> m")
            .select("v", "m")
            .union(lower.select(F.col("u").alias("v"), "m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        after = durable(small)
        # Done when no node is a child of two roots and no root is a child itself.
        children = after.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        twice = children.where("n > 1").select("u")
        nested = after.join(children.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi")
        edges = after
        if twice.union(nested.select("u")).isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def smallest_of_component(prints: DataFrame, value: Column) -> DataFrame:
    """fp and the smallest `value` in its component, as `smallest`."""
    distinct = durable(prints.groupBy("fp").agg(F.min(value).alias("first")))
    roots = components(spanning_links(distinct.select("fp")))
    labelled = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("smallest"))
    return labelled.select("fp", "root").join(smallest, "root").select("fp", "smallest")


def linked(prints: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id from (doc_id, fp)."""
    of_print = smallest_of_component(prints, F.col("doc_id")).withColumnRenamed(
        "smallest", "component_id"
    )
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    return linked(durable(with_fingerprints(docs, text, doc_id)))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component, with all its columns: one with the smallest id.

    Rows are told apart by id and text. Rows without an id come after the others of their
    component; of rows that repeat both id and text, one stays.
    """
    key = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
    prints = durable(with_fingerprints(docs, text, doc_id, key))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    marks = (
        prints.join(smallest_of_component(prints, own), "fp")
        .groupBy(F.col("doc_id").alias("marked_id"), F.col("key").alias("marked_key"))
        .agg(F.max(own.eqNullSafe(F.col("smallest"))).alias("kept"), F.count(F.lit(1)).alias("n"))
        .where("not kept or n > 1")
        .drop("n")
    )
    return one_of_each(docs, marks, doc_id, key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
