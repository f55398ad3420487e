"""Hard-negative mining by angular triangle filtering.

Vectors are taken as integers, floor(256 x). An anchor's positives are the rows of its label
with the largest inner products; the negatives of each positive are the best rows of another
label whose product lies in a window below the positive's.

Every row stores its angles to a few reference directions and its norm. For an anchor at angle
a and a row at angle x to the same direction, the angle between them is at least |a - x| and
at most a + x (and 2 pi - a - x), so its cosine lies between cos a cos x - sin a sin x and
cos a cos x + sin a sin x. The tightest of these intervals over all directions, times both
norms and widened by more than any rounding, bounds the product. A row whose interval misses
the anchor's windows is not scored; the others are, in integers.

Rows are packed into blocks of a bounded size, anchors into smaller ones, both by nearest
direction and label. The extremes of a block's angles give the same bounds for whole pairs of
blocks; pairs that may overlap meet by equi-joins on their numbers, a pair per row. Positives
are looked for in two passes: the blocks an anchor stands in give it a floor, and only rows
that may exceed the floor are looked at in the others. A hot label is many blocks.

The directions are chosen from a sample of at most `SAMPLE_ROWS` rows, far from each other;
the bounds hold for any, and every row is measured against all of them.

Rows with a null label, a null vector, or a component that is null or not finite (also after
the multiplication) take no part. A null id is no anchor and its label stays; it comes last
among ties. Rows that repeat an id, or everything, are rows of their own. Vectors of different
lengths are compared as if the shorter ended in zeros; the zero vector and the empty one have
the product 0 with all. Sums are exact beyond 53 bits; one that no long holds is shown, and
ordered, as the nearest long. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderlake.llm.common import durable, hash_sample, ship

#: Every so many ids is an anchor, and every so many gets the next label.
ANCHOR_EVERY, SHIFT_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
DIRECTIONS = 8
SAMPLE_ROWS = 4_096
#: Bytes of vectors (8 a component) in a block of rows, and in one of anchors.
BLOCK_BYTES, ANCHOR_BYTES = 2 << 20, 1 << 19
#: Labels are dealt to so many groups; a block has few of them.
LABEL_GROUPS = 16
#: Anchors whose bounds are computed at once.
STEP = 128
#: More than the rounding of stored angles (single precision) and of cosines.
SLACK = 1e-6
LOW, HIGH = -(1 << 63), (1 << 63) - 1


# --- vectors ------------------------------------------------------------------------------------


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label (shifted for every seventh id) and vector of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * 256.0) < float("inf"))
    )
    label, vec_id = F.col("label").cast("bigint"), F.col("vec_id").cast("bigint")
    moved = F.when(vec_id % SHIFT_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        vec_id.alias("vec_id"), moved.alias("label"), vector.alias("vector")
    )


def matrix(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """The integer vectors as rows of equal length, exact in doubles."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(256.0 * np.asarray(v, np.float64))
    return out


def packed(q: np.ndarray) -> tuple[bytes, str]:
    """The matrix in the narrowest type that holds it."""
    most = np.abs(q).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return q.astype(kind).tobytes(), kind


def norms_of(q: np.ndarray) -> np.ndarray:
    """Lengths; scaled, so that no square overflows."""
    most = np.maximum(np.abs(q).max(axis=1, initial=0), 1.0)
    return np.sqrt(((q / most[:, None]) ** 2).sum(axis=1)) * most


def unit(q: np.ndarray) -> np.ndarray:
    norms = norms_of(q)
    return q / np.where(norms > 0, norms, 1.0)[:, None]


def angles_to(q: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of the rows to the directions; a right angle for the zero vector."""
    return np.arccos(np.clip(unit(q) @ directions.T, -1.0, 1.0)).astype(np.float32)


def far_apart(q: np.ndarray, count: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors of the sample, each far from those chosen before."""
    units = unit(q[np.abs(q).max(axis=1, initial=0) > 0])
    if not len(units):
        return np.zeros((0, q.shape[1]))
    chosen = [0]
    nearest = units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: doubles where they suffice, else Python's integers."""
    reach = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(x).max(initial=0))
    if reach < 1 << 53:
        return (a @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    found = whole(a) @ whole(x).T
    return np.clip(found, LOW, HIGH).astype(np.int64)


# --- the filter -----------------------------------------------------------------------------------


def score_bounds(
    a: np.ndarray, a_norm: np.ndarray, x: np.ndarray, x_norm: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of every anchor's product with every row, from angles and norms alone."""
    low = np.full((len(a), len(x)), -1.0)
    high = np.full((len(a), len(x)), 1.0)
    for r in range(a.shape[1]):
        along = np.outer(np.cos(a[:, r], dtype=float), np.cos(x[:, r], dtype=float))
        across = np.outer(np.sin(a[:, r], dtype=float), np.sin(x[:, r], dtype=float))
        np.maximum(low, along - across, out=low)
        np.minimum(high, along + across, out=high)
    size = np.outer(a_norm, x_norm)
    slack = size * SLACK + 1.0
    return low * size - slack, high * size + slack


def best_in_window(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, most: int) -> np.ndarray:
    """Places of the largest scores, ties by smaller id, null ids last."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    # Unlike -score, ~score cannot overflow.
    return near[np.lexsort((ids[near], nulls[near], ~scores[near]))][:most]


HIT = (
    "a_block bigint, a_place int, tag int, score bigint, vec_id bigint, "
    "x_block bigint, x_place int"
)


class _Packed:
    """A block read back: q, norms, angles, labels, ids."""

    def __init__(self, row: dict, side: str) -> None:
        n = row[f"{side}_n"]
        self.n, self.width = n, row[f"{side}_width"]
        self.q = np.frombuffer(row[f"{side}_q"], row[f"{side}_kind"]).reshape(n, self.width)
        self.norms = np.frombuffer(row[f"{side}_norms"], "<f8")
        self.angles = np.frombuffer(row[f"{side}_angles"], "<f4").reshape(n, -1)
        self.labels = np.asarray(row[f"{side}_labels"], np.int64)
        ids = row[f"{side}_ids"]
        self.nulls = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)

    def vectors(self, rows, width: int) -> np.ndarray:
        out = np.zeros((len(rows), width))
        out[:, : self.width] = self.q[rows]
        return out


def pair_hits(row: dict, same: bool, most: int) -> list[tuple]:
    """The best rows of a block in every window of the anchors of another."""
    a, x = _Packed(row, "a"), _Packed(row, "x")
    homes, places = row["a_homes"], row["a_places"]
    windows = row["a_windows"]
    width = max(a.width, x.width)
    lows = np.array([min((w["low"] for w in ws), default=HIGH) for ws in windows], float)
    highs = np.array([max((w["high"] for w in ws), default=LOW) for ws in windows], float)
    hits = []
    for start in range(0, a.n, STEP):
        at = slice(start, min(start + STEP, a.n))
        low, high = score_bounds(a.angles[at], a.norms[at], x.angles, x.norms)
        wanted = (a.labels[at, None] == x.labels) == same
        wanted &= (high >= lows[at, None]) & (low <= highs[at, None])
        if same:
            for i in range(at.start, at.stop):
                if homes[i] == row["x_block"]:
                    wanted[i - start, places[i]] = False
        columns = np.flatnonzero(wanted.any(axis=0))
        if not len(columns):
            continue
        anchors = a.vectors(np.arange(at.start, at.stop), width)
        scores = products(anchors, x.vectors(columns, width))
        wanted = wanted[:, columns]
        for i in range(at.start, at.stop):
            own = np.flatnonzero(wanted[i - start])
            seen = scores[i - start, own]
            for w in windows[i]:
                inside = np.flatnonzero((seen >= w["low"]) & (seen <= w["high"]))
                rows = columns[own[inside]]
                for j in best_in_window(seen[inside], x.ids[rows], x.nulls[rows], most):
                    row_id = None if x.nulls[rows[j]] else int(x.ids[rows[j]])
                    hits.append(
                        (homes[i], places[i], w["tag"], int(seen[inside[j]]), row_id, row["x_block"], int(rows[j]))
                    )
    return hits


def _scored(same: bool, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    names = [field.split()[0] for field in HIT.split(", ")]
    for batch in batches:
        for i in range(batch.num_rows):
            hits = pair_hits(batch.slice(i, 1).to_pylist()[0], same, most)
            columns = zip(*hits) if hits else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names
            )


# --- blocks ---------------------------------------------------------------------------------------

MEASURED = "vec_id bigint, label bigint, vector array<double>, cell int"
BLOCK = (
    "{side}_block bigint, {side}_n int, {side}_width int, {side}_kind string, {side}_q binary, "
    "{side}_norms binary, {side}_angles binary, {side}_labels array<bigint>, "
    "{side}_ids array<bigint>, {side}_groups array<int>, {side}_low array<double>, "
    "{side}_high array<double>, {side}_short double, {side}_long double"
)


def _measured(directions: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The direction that every row is nearest to."""
    for batch in batches:
        if batch.num_rows:
            q = matrix(_vectors_of(batch.column("vector")), directions.shape[1])
            near = angles_to(q, directions).argmin(axis=1) if len(directions) else np.zeros(len(q))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32))], [*batch.schema.names, "cell"]
            )


def _vectors_of(column: pa.Array) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    return np.split(values, np.cumsum(sizes)[:-1])


def _block(directions: np.ndarray, side: str, table: pa.Table) -> dict:
    """The columns of a block, from the rows of it."""
    vectors = _vectors_of(table.column("vector").combine_chunks())
    width = max(map(len, vectors))
    q = matrix(vectors, width) if side == "x" else _plain(vectors, width)
    value, kind = packed(q)
    norms = norms_of(q)
    full = np.zeros((len(q), max(width, directions.shape[1])))
    full[:, :width] = q
    angles = angles_to(full[:, : directions.shape[1]], directions)
    if not len(directions):
        angles = np.zeros((len(q), 0), np.float32)
    return {
        f"{side}_block": [table.column("block")[0].as_py()],
        f"{side}_n": [len(q)],
        f"{side}_width": [width],
        f"{side}_kind": [kind],
        f"{side}_q": [value],
        f"{side}_norms": [norms.astype("<f8").tobytes()],
        f"{side}_angles": [angles.astype("<f4").tobytes()],
        f"{side}_labels": [table.column("label").to_pylist()],
        f"{side}_ids": [table.column("vec_id").to_pylist()],
        f"{side}_groups": [sorted(set(table.column("group").to_pylist()))],
        f"{side}_low": [angles.min(axis=0).astype(float).tolist()],
        f"{side}_high": [angles.max(axis=0).astype(float).tolist()],
        f"{side}_short": [float(norms.min())],
        f"{side}_long": [float(norms.max())],
    }


def _plain(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors that are integers already."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


_ARROW = {
    "block": pa.int64(), "n": pa.int32(), "width": pa.int32(), "kind": pa.string(),
    "q": pa.binary(), "norms": pa.binary(), "angles": pa.binary(),
    "labels": pa.list_(pa.int64()), "ids": pa.list_(pa.int64()), "groups": pa.list_(pa.int32()),
    "low": pa.list_(pa.float64()), "high": pa.list_(pa.float64()),
    "short": pa.float64(), "long": pa.float64(),
}


def _row_block(directions: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    def pack(table: pa.Table) -> pa.Table:
        made = _block(directions, "x", table)
        return pa.table({c: pa.array(v, _ARROW[c[2:]]) for c, v in made.items()})

    return pack


_WINDOWS = pa.list_(
    pa.list_(pa.struct([("tag", pa.int32()), ("low", pa.int64()), ("high", pa.int64())]))
)
ANCHOR_BLOCK = (
    f"{BLOCK.format(side='a')}, a_homes array<bigint>, a_places array<int>, "
    "a_windows array<array<struct<tag: int, low: bigint, high: bigint>>>"
)


def _anchor_block(directions: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    def pack(table: pa.Table) -> pa.Table:
        made = _block(directions, "a", table)
        columns = {c: pa.array(v, _ARROW[c[2:]]) for c, v in made.items()}
        columns["a_homes"] = pa.array([table.column("a_block").to_pylist()], pa.list_(pa.int64()))
        columns["a_places"] = pa.array([table.column("a_place").to_pylist()], pa.list_(pa.int32()))
        columns["a_windows"] = pa.array([table.column("windows").to_pylist()], _WINDOWS)
        return pa.table(columns)

    return pack


def dealt(counts: dict[tuple[int, int], int], most: int) -> tuple[dict, int]:
    """Block numbers: for every (group, cell) its first block and how many it is split into.

    Small neighbours share a block. The second value is the number of blocks.
    """
    places, block, held = {}, 0, 0
    for key in sorted(counts):
        n = counts[key]
        if held and held + n > most:
            block, held = block + 1, 0
        parts = max(1, -(-n // most))
        places[key] = (block, parts)
        if parts > 1:
            block, held = block + parts, 0
        else:
            held += n
    return places, block + (held > 0)


def _with_block(rows: DataFrame, most: int) -> tuple[DataFrame, int]:
    """`rows` with the number of their block, and how many blocks there are.

    What is collected is a count per label group and direction, of which there are few.
    """
    counts = {
        (r["group"], r["cell"]): r["count"] for r in rows.groupBy("group", "cell").count().collect()
    }
    places, blocks = dealt(counts, most)
    if not places:
        return rows.withColumn("block", F.lit(0).cast("bigint")), 0
    code = F.col("group") * F.lit(DIRECTIONS) + F.col("cell")
    first, parts = (
        F.create_map(
            *[F.lit(v) for (g, c), p in places.items() for v in (g * DIRECTIONS + c, p[i])]
        )[code]
        for i in (0, 1)
    )
    nth = F.pmod(F.monotonically_increasing_id(), parts)
    return rows.withColumn("block", (first + nth).cast("bigint")), blocks


def _anchors_of(directions: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["a_block", "a_place", "vec_id", "label", "vector", "cell"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.int32()]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            x = _Packed(row, "x")
            chosen = np.flatnonzero(~x.nulls & (x.ids % ANCHOR_EVERY == 0))
            near = x.angles[chosen].argmin(axis=1) if x.angles.shape[1] else np.zeros(len(chosen))
            rows = [
                (row["x_block"], int(p), int(x.ids[p]), int(x.labels[p]), x.q[p].astype(float).tolist(), int(c))
                for p, c in zip(chosen, near)
            ]
            columns = zip(*rows) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names
            )


# --- the plan -------------------------------------------------------------------------------------


def _may_overlap() -> Column:
    """Whether the bounds of a pair of blocks meet the hull of the anchors' windows."""
    pi = float(np.pi)
    minus, plus = (lambda p, q: p - q), (lambda p, q: p + q)
    apart = F.greatest(
        F.array_max(F.zip_with("x_low", "a_high", minus)),
        F.array_max(F.zip_with("a_low", "x_high", minus)),
        F.lit(0.0),
    )
    together = F.zip_with(
        F.zip_with("a_low", "x_low", plus),
        F.zip_with("a_high", "x_high", plus),
        lambda low, high: F.when(high <= pi, high).when(low >= pi, 2 * pi - low).otherwise(pi),
    )
    high = F.cos(apart)
    low = F.cos(F.coalesce(F.array_min(together), F.lit(pi)))
    long, short = F.col("a_long") * F.col("x_long"), F.col("a_short") * F.col("x_short")
    slack = long * SLACK + 1.0
    most = high * F.when(high > 0, long).otherwise(short) + slack
    least = low * F.when(low > 0, short).otherwise(long) - slack
    return (most >= F.col("a_floor")) & (least <= F.col("a_ceiling"))


SUMMARY = ("block", "groups", "low", "high", "short", "long")


def search(anchors: DataFrame, rows: DataFrame, blocks: int, same: bool, most: int, home: bool | None = None) -> DataFrame:
    """The best `most` rows of each anchor's windows, of its label or of others.

    `home` keeps to the blocks that the anchors stand in, or to the others.
    """
    windows = F.flatten("a_windows")
    a = anchors.select(
        *[f"a_{c}" for c in SUMMARY], "a_homes",
        F.array_min(F.transform(windows, lambda w: w["low"])).cast("double").alias("a_floor"),
        F.array_max(F.transform(windows, lambda w: w["high"])).cast("double").alias("a_ceiling"),
    )
    # The stated query set against all rows, in blocks: every block of anchors asks for every
    # block of rows by number, and the bounds say which pairs meet.
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(max(blocks - 1, 0)).cast("bigint"))
    asked = a.withColumn("x_block", F.explode(numbers))
    pairs = asked.join(rows.select(*[f"x_{c}" for c in SUMMARY]), "x_block").where(_may_overlap())
    if same:
        pairs = pairs.where(F.arrays_overlap("a_groups", "x_groups"))
    if home is not None:
        pairs = pairs.where(F.array_contains("a_homes", F.col("x_block")) == home)
    whole = durable(pairs.select("a_block", "x_block"))
    hits = (
        whole.join(rows, "x_block")
        .join(anchors, "a_block")
        .drop(*[f"{s}_{c}" for s in "ax" for c in ("groups", "low", "high", "short", "long")])
        .mapInArrow(partial(_scored, same, most), HIT)
    )
    return durable(_top(hits, most))


def _top(hits: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("a_block", "a_place", "tag").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "x_block", "x_place"
    )
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    ship(spark)
    used = usable(rows)
    sample = hash_sample(used, SAMPLE_ROWS, "vec_id").select("vector").limit(SAMPLE_ROWS)
    vectors = [np.asarray(r["vector"], float) for r in sample.collect()]
    width = used.agg(F.max(F.size("vector"))).first()[0] or 0
    directions = far_apart(matrix(vectors, width))
    group = F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)).cast("int").alias("group")

    measured = used.mapInArrow(partial(_measured, directions), MEASURED).select("*", group)
    dealt_rows, blocks = _with_block(measured, max(256, BLOCK_BYTES // (8 * max(width, 1))))
    x = durable(
        dealt_rows.groupBy("block").applyInArrow(
            _row_block(directions), BLOCK.format(side="x")
        )
    )
    found = durable(
        x.mapInArrow(
            partial(_anchors_of, directions),
            "a_block bigint, a_place int, vec_id bigint, label bigint, vector array<double>, cell int",
        ).select("*", group)
    )
    numbered, _ = _with_block(found, max(64, ANCHOR_BYTES // (8 * max(width, 1))))
    anchors = durable(numbered)

    def in_blocks(asking: DataFrame) -> DataFrame:
        return durable(
            asking.groupBy("block").applyInArrow(_anchor_block(directions), ANCHOR_BLOCK)
        )

    def window(tag, low, high) -> Column:
        return F.struct(
            tag.cast("int").alias("tag"), low.cast("bigint").alias("low"), high.cast("bigint").alias("high")
        )

    who = ["a_block", "a_place"]
    everything = F.array(window(F.lit(0), F.lit(LOW), F.lit(HIGH)))
    near = search(in_blocks(anchors.withColumn("windows", everything)), x, blocks, True, POSITIVES, home=True)
    floors = near.where(F.col("rank") == POSITIVES).select(*who, F.col("score").alias("floor"))
    floor = F.coalesce("floor", F.lit(LOW))
    above = anchors.join(floors, who, "left").withColumn(
        "windows", F.array(window(F.lit(0), floor, F.lit(HIGH)))
    )
    far = search(in_blocks(above.drop("floor")), x, blocks, True, POSITIVES, home=False)
    positives = durable(_top(near.drop("rank").union(far.drop("rank")), POSITIVES))

    score = F.col("score")
    # 50 p <= 100 n <= 95 p in whole numbers; no n satisfies it for a p below zero.
    low = F.expr("score div 2 + score % 2")
    high = F.expr("score - score div 20 - CASE WHEN score % 20 > 0 THEN 1 ELSE 0 END")
    asked = (
        positives.where((score >= 0) & (low <= high))
        .groupBy(*who)
        .agg(F.collect_list(window(F.col("rank"), low, high)).alias("windows"))
    )
    negatives = search(in_blocks(anchors.join(asked, who)), x, blocks, False, NEGATIVES)
    return (
        negatives.select(*who, "tag", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(
            positives.select(
                *who, F.col("rank").alias("tag"), F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
            ),
            [*who, "tag"],
        )
        .join(anchors.select(*who, F.col("vec_id").alias("anchor_id")), who)
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id",
            "positive_score", "negative_score",
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives(rows.select("vec_id", "embedding", "label"))


SQL = """
WITH taken AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM taken a JOIN taken b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
 AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
