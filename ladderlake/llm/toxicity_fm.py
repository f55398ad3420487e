"""Toxicity: a factorization machine over hashed terms.

A text's terms are its lower-cased words and their leading characters, hashed; a term
counts once per text. The machine adds a weight per term and, for every pair of terms of a
text, the product of their factor vectors: an insult next to a group mention can weigh more
than both do alone. The pairs are summed through the factors, in time linear in the terms.

Learning: at most `SAMPLE_ROWS` labelled rows outside the held-out fold (the ids with the
smallest hashes). Their terms are counted in Spark, and the `TERMS` hashes that tell the
classes apart best become the machine's inputs. Only (row, input) pairs of the sample reach
the driver. The labels, lang, source and doc_id are no inputs.

Null texts are empty texts and get the score of a text without terms. A null id keeps its
row. Without labelled rows every score is 0.5. Repeated rows get equal scores. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import (
    LOW_BYTES,
    append,
    crc_fold,
    durable,
    lanes,
    sampled_labels,
    tailed,
    text_buffer,
    words_of,
)

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Labelled rows that the model is fitted on at most, and its inputs and factors.
SAMPLE_ROWS = 8_192
TERMS, FACTORS = 1_024, 8
#: Hash buckets of terms, as a power of two, and lengths of leading parts in bytes.
BUCKET_BITS = 22
LEADING = (4, 5, 6)
EPOCHS, BATCH, RATE = 60, 256, 0.03
WEIGHT_DECAY, FACTOR_DECAY = 3e-5, 3e-3


def _not_word() -> np.ndarray:
    table = np.ones(256, bool)
    table[ord("0") : ord("9") + 1] = False
    table[ord("A") : ord("Z") + 1] = False
    table[ord("a") : ord("z") + 1] = False
    table[128:] = False
    return table


NOT_WORD = _not_word()


def _bucket(key: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = (key + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
        key = (key ^ (key >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (key >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, bucket) of all terms, repeats included, and the number of texts."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    data, offsets = text_buffer(lower)
    compact, start, end, _, first = words_of(data, offsets, NOT_WORD)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    lane, size = lanes(tailed(compact)), end - start
    head = lane[start]
    with np.errstate(over="ignore"):
        whole = (head & LOW_BYTES[np.minimum(size, 8)]) * np.uint64(0xD6E8FEB86659FD93)
        whole ^= lane[np.maximum(end - 8, start)] & LOW_BYTES[np.minimum(size, 8)]
        whole += size.astype(np.uint64)
    docs, buckets = [doc], [_bucket(whole, 0)]
    for length in LEADING:
        on = size > length
        docs.append(doc[on])
        buckets.append(_bucket(head[on] & LOW_BYTES[length], length))
    return np.concatenate(docs), np.concatenate(buckets), n


@dataclass
class Machine:
    bias: float
    buckets: np.ndarray
    weight: np.ndarray
    factor: np.ndarray

    def score(self, doc: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.buckets, bucket), max(len(self.buckets) - 1, 0))
        hit = self.buckets[at] == bucket if len(self.buckets) else np.zeros(len(bucket), bool)
        cell = np.unique(doc[hit] * max(len(self.buckets), 1) + at[hit])
        doc, at = np.divmod(cell, max(len(self.buckets), 1))
        raw = self.bias + np.bincount(doc, self.weight[at], n)
        for k in range(self.factor.shape[1]):
            value = self.factor[at, k]
            raw += 0.5 * (np.bincount(doc, value, n) ** 2 - np.bincount(doc, value**2, n))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(inputs: np.ndarray, label: np.ndarray, buckets: np.ndarray) -> Machine:
    """Adam on the logistic loss over minibatches, the same on every run."""
    rng = np.random.default_rng(7)
    n, width = inputs.shape
    share = (label.sum() + 1) / (n + 2)
    bias = np.array([np.log(share / (1 - share))])
    weight, factor = np.zeros(width), rng.normal(0, 0.02, (width, FACTORS))
    if not n or not width or label.min() == label.max():
        return Machine(float(bias[0]), buckets[:0], weight[:0], factor[:0])
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (bias, weight, factor)]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for begin in range(0, n, BATCH):
            rows = order[begin : begin + BATCH]
            x = inputs[rows].astype(np.float64)
            summed = x @ factor
            raw = bias[0] + x @ weight + 0.5 * ((summed**2).sum(1) - (x @ factor**2).sum(1))
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[rows]
            slopes = (
                np.array([error.mean()]),
                x.T @ error / len(rows) + WEIGHT_DECAY * weight,
                (x.T @ (error[:, None] * summed) - (x.T @ error)[:, None] * factor) / len(rows)
                + FACTOR_DECAY * factor,
            )
            step += 1
            for value, slope, (mean, spread) in zip((bias, weight, factor), slopes, state):
                mean += 0.1 * (slope - mean)
                spread += 0.001 * (slope**2 - spread)
                value -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return Machine(float(bias[0]), buckets, weight, factor)


def _bucket_lists(texts: pa.Array) -> list[pa.Array]:
    doc, bucket, n = terms(texts)
    cell = np.unique(doc << BUCKET_BITS | bucket)
    bounds = np.searchsorted(cell, np.arange(n + 1) << BUCKET_BITS)
    values = pa.array((cell & ((1 << BUCKET_BITS) - 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values)]


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Machine:
    """Count the sample's terms in Spark, choose the inputs, fit the machine."""
    sample = sampled_labels(labels, "toxic", FOLDS, HELD_OUT, SAMPLE_ROWS)
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
        F.broadcast(sample), "doc_id"
    )
    # A row per labelled text: at most the sample's rows, but for ids that the table repeats.
    rows = durable(
        append(chosen, _bucket_lists, "buckets array<int>", keep=["doc_id", "label"])
        .orderBy("doc_id", "buckets")
        .limit(2 * SAMPLE_ROWS)
        .withColumn("row", F.monotonically_increasing_id())
    )
    size, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not size or not ones or ones == size:
        return fit(np.zeros((size, 0)), np.full(size, bool(ones), float), np.zeros(0, np.int64))
    counted = (
        rows.select("label", F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("label").cast("double").alias("k"))
    )
    share = ones / size
    # How far the class share among the term's texts is from that of all, in deviations.
    apart = F.abs(F.col("k") - F.col("n") * share) / F.sqrt(
        F.col("n") * share * (1 - share) + F.lit(1.0)
    )
    inputs = (
        counted.where("n >= 4").orderBy(apart.desc(), "bucket").limit(TERMS).select("bucket")
    )
    buckets = np.sort(inputs.toPandas()["bucket"].to_numpy(np.int64))
    cells = (
        rows.select("row", F.explode("buckets").alias("bucket"))
        .join(F.broadcast(inputs), "bucket")
        .select(F.col("row"), F.col("bucket"))
        .toPandas()
    )
    given = rows.select("row", "label").toPandas().sort_values("row")
    place = {row: i for i, row in enumerate(given["row"])}
    matrix = np.zeros((len(given), len(buckets)), np.float32)
    matrix[
        cells["row"].map(place).to_numpy(np.int64),
        np.searchsorted(buckets, cells["bucket"].to_numpy(np.int64)),
    ] = 1
    return fit(matrix, given["label"].to_numpy(float), buckets)


def classify(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    machine = train(narrow, labels)

    def compute(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(machine.score(*terms(texts)))]

    return append(narrow, compute, "score double", keep=["doc_id"]).select(
        "doc_id",
        (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/labels.parquet"),
    )
