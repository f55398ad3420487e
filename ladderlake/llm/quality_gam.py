"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins; cyclic boosting visits the features in turn and adds a
shallow tree over the feature's bins to its lookup table, then does the same for the
strongest pairs of features over coarser bins. A score is a sum of table entries: one
vectorised lookup and addition per feature and pair.

The features are counts over the whole text (lengths, character classes, repetition),
computed together for a slice of texts. The model is fitted on at most `SAMPLE_ROWS`
labelled rows outside the held-out fold (the ids with the smallest hashes); only their
features reach the driver. The labels, lang, source and doc_id are no features.

Null texts are empty texts and get a score like any other. A null id keeps its row.
Without labelled rows every score is 0.5. Repeated rows get equal scores. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import (
    LOW_BYTES,
    SPACE,
    append,
    crc_fold,
    lanes,
    sampled_labels,
    tailed,
    text_buffer,
    unused,
    words_of,
)

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
#: Labelled rows that the model is fitted on at most.
SAMPLE_ROWS = 8_192
BINS, PAIR_BINS = 48, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 40, 8
RATE = 0.15

UPPER, LETTER, DIGIT, BLANK, BREAK, BANG, BAR, SIGN, STOP, MARK, WIDE = range(11)


def _character_classes() -> np.ndarray:
    table = np.full(256, MARK, np.uint8)
    table[ord("A") : ord("Z") + 1] = UPPER
    table[ord("a") : ord("z") + 1] = LETTER
    table[ord("0") : ord("9") + 1] = DIGIT
    table[SPACE] = BLANK
    table[ord("\n")] = BREAK
    table[ord("!")] = BANG
    table[ord("|")] = BAR
    table[[ord(c) for c in "#$%&*@^~=<>+_"]] = SIGN
    table[ord(".")] = STOP
    table[128:] = WIDE
    return table


CLASSES = _character_classes()
FEATURES = (
    "log_bytes log_words word_length word_spread upper digits blanks bangs bars signs stops "
    "marks wide breaks distinct_words distinct_pairs repeats top_word marked_ends no_letters short"
).split()


def _distinct(keys: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: how many distinct keys, and how often the most frequent one occurs."""
    mixed = (keys << np.uint64(21)) | doc.astype(np.uint64)
    values, counts = np.unique(mixed, return_counts=True)
    of = (values & np.uint64((1 << 21) - 1)).astype(np.int64)
    most = np.zeros(n)
    np.maximum.at(most, of, counts)
    return np.bincount(of, minlength=n), most


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    data, offsets = text_buffer(texts)
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    doc_of_byte = np.repeat(np.arange(n), sizes)
    kinds = CLASSES[data]
    counts = np.bincount(doc_of_byte * 11 + kinds, minlength=11 * n).reshape(n, 11).astype(float)
    counts[:, BREAK] -= 1  # the one that closes each text
    size = np.maximum(sizes - 1, 1)

    compact, start, end, _, first = words_of(data, offsets, SPACE)
    words = np.diff(first)
    some = np.maximum(words, 1)
    doc = np.repeat(np.arange(n), words)
    length = end - start
    lane = lanes(tailed(compact))
    with np.errstate(over="ignore"):
        key = lane[start] & LOW_BYTES[np.minimum(length, 8)]
        key = key * np.uint64(0x9E3779B97F4A7C15) ^ lane[np.maximum(end - 8, start)]
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + length.astype(np.uint64)
        key ^= key >> np.uint64(32)
        pair = key[:-1] * np.uint64(0x94D049BB133111EB) ^ key[1:]
        pair ^= pair >> np.uint64(31)
    same = doc[:-1] == doc[1:]
    distinct, most = _distinct(key, doc, n)
    distinct_pairs, _ = _distinct(pair[same], doc[:-1][same], n)
    repeats = np.bincount(doc[:-1][same & (key[:-1] == key[1:])], minlength=n)
    sums = np.bincount(doc, length, minlength=n)
    squares = np.bincount(doc, length.astype(float) ** 2, minlength=n)
    mean = sums / some
    last = CLASSES[compact[end - 1]] if len(end) else np.zeros(0, np.uint8)
    marked = np.bincount(doc, np.isin(last, [BANG, BAR, SIGN, MARK]), minlength=n)
    lettered = np.isin(CLASSES[compact], [UPPER, LETTER, WIDE]) if len(end) else np.zeros(1, bool)
    has = np.add.reduceat(lettered, start) > 0 if len(start) else np.zeros(0, bool)
    bare = np.bincount(doc, ~has, minlength=n)
    letters = counts[:, UPPER] + counts[:, LETTER] + counts[:, WIDE]
    return np.column_stack(
        [
            np.log1p(size),
            np.log1p(words),
            mean,
            np.sqrt(np.maximum(squares / some - mean**2, 0)),
            counts[:, UPPER] / np.maximum(letters, 1),
            counts[:, DIGIT] / size,
            counts[:, BLANK] / size,
            counts[:, BANG] / some,
            counts[:, BAR] / some,
            counts[:, SIGN] / some,
            counts[:, STOP] / some,
            counts[:, MARK] / some,
            counts[:, WIDE] / size,
            counts[:, BREAK] / some,
            distinct / some,
            distinct_pairs / np.maximum(words - 1, 1),
            repeats / some,
            most / some,
            marked / some,
            bare / some,
            np.bincount(doc, length <= 2, minlength=n) / some,
        ]
    )


def _probability(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


@dataclass
class Model:
    """Lookup tables by feature and by pair of features."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, rows: np.ndarray) -> np.ndarray:
        raw = np.full(len(rows), self.base)
        for j, table in enumerate(self.tables):
            raw += table[np.searchsorted(self.edges[j], rows[:, j], "right")]
        for a, b, table in self.pairs:
            raw += table[
                np.searchsorted(self.coarse[a], rows[:, a], "right"),
                np.searchsorted(self.coarse[b], rows[:, b], "right"),
            ]
        return _probability(raw)


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between neighbouring values, near the quantiles."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
    return (values[:-1] + values[1:]) / 2


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Newton steps of a tree with a few leaves over ordered bins."""
    out = np.zeros(len(gradient))
    parts = [(0, len(gradient))]
    total = lambda a, b: gradient[a:b].sum() ** 2 / (weight[a:b].sum() + 1.0)
    while len(parts) < leaves:
        best = (1e-9, None)
        for i, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            g, w = np.cumsum(gradient[a:b]), np.cumsum(weight[a:b])
            gain = g[:-1] ** 2 / (w[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (w[-1] - w[:-1] + 1)
            at = int(np.argmax(gain))
            if gain[at] - total(a, b) > best[0]:
                best = (gain[at] - total(a, b), (i, a + at + 1))
        if best[1] is None:
            break
        i, cut = best[1]
        a, b = parts[i]
        parts[i : i + 1] = [(a, cut), (cut, b)]
    for a, b in parts:
        out[a:b] = gradient[a:b].sum() / (weight[a:b].sum() + 1.0)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps of the best tree that cuts each of two features once, and its gain."""
    g, w = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    parts = []
    for q in (g, w):
        low = q[:-1, :-1]
        parts.append((low, q[:-1, -1:] - low, q[-1:, :-1] - low, q[-1, -1] - q[:-1, -1:] - q[-1:, :-1] + low))
    gain = sum(a**2 / (b + 1) for a, b in zip(*parts))
    if not gain.size:
        return np.zeros_like(gradient), 0.0
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    step = np.zeros_like(gradient)
    values = [a[i, j] / (b[i, j] + 1) for a, b in zip(*parts)]
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :] = values[0], values[1]
    step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = values[2], values[3]
    return step, float(gain[i, j])


def fit(rows: np.ndarray, label: np.ndarray) -> Model:
    """Cyclic boosting of one table per feature, then of the strongest pairs."""
    n, width = rows.shape
    share = (label.sum() + 1) / (n + 2)
    model = Model(float(np.log(share / (1 - share))))
    if not n or label.min() == label.max():
        return model
    raw = np.full(n, model.base)
    model.edges = [_edges(rows[:, j], BINS) for j in range(width)]
    model.coarse = [_edges(rows[:, j], PAIR_BINS) for j in range(width)]
    fine = [np.searchsorted(e, rows[:, j], "right") for j, e in enumerate(model.edges)]
    broad = [np.searchsorted(e, rows[:, j], "right") for j, e in enumerate(model.coarse)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]

    def slopes():
        p = _probability(raw)
        return label - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, w = slopes()
            step = RATE * _tree(
                np.bincount(fine[j], g, len(table)), np.bincount(fine[j], w, len(table))
            )
            table += step
            raw += step[fine[j]]

    def over_pair(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, w = slopes()
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        cell = broad[a] * shape[1] + broad[b]
        size = shape[0] * shape[1]
        return (np.bincount(cell, g, size).reshape(shape), np.bincount(cell, w, size).reshape(shape))

    gains = sorted(
        ((_quadrants(*over_pair(a, b))[1], a, b) for a in range(width) for b in range(a)),
        reverse=True,
    )
    for _, a, b in gains[:PAIRS]:
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        model.pairs.append((a, b, np.zeros(shape)))
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            step = RATE * _quadrants(*over_pair(a, b))[0]
            table += step
            raw += step[broad[a], broad[b]]
    for table in model.tables:
        table -= 0.0
    return model


def _feature_rows(texts: pa.Array) -> list[pa.Array]:
    return [pa.array(list(features(texts)), pa.list_(pa.float64()))]


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Model:
    """Fit on the labelled sample; the documents are read once, and only the sample's kept."""
    sample = sampled_labels(labels, "quality", FOLDS, HELD_OUT, SAMPLE_ROWS)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(sample), "doc_id"
    )
    rows = append(chosen, _feature_rows, "features array<double>", keep=["doc_id", "label"])
    frame = rows.orderBy("doc_id", "features").limit(2 * SAMPLE_ROWS).toPandas()
    matrix = np.array(frame["features"].tolist()).reshape(len(frame), len(FEATURES))
    return fit(matrix, frame["label"].to_numpy(float))


def scored(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    keep: list[str] | None = None,
    name: str = "score",
) -> DataFrame:
    """`keep` (all columns if not given) and the score of each text."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(model.score(features(texts)))]

    return append(docs, compute, f"`{name}` double", text, keep)


def classify(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return scored(narrow, train(narrow, labels), keep=["doc_id"]).select(
        "doc_id",
        (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that the model accepts, with all their columns."""
    (name,) = unused(docs.columns, "__quality")
    model = train(docs, labels, text, doc_id)
    return scored(docs, model, text, name=name).where(F.col(name) >= THRESHOLD).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/labels.parquet"),
    )
