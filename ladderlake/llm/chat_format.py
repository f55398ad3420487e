"""Chat formatting by columnar byte assembly.

Every turn becomes `<s>[INST] role [/INST] text</s>`, and a conversation is its turns in
order. Control strings (`<s>`, `</s>`, `[INST]`, `[/INST]`) inside a role or a text get a
backslash behind their first character, and every backslash there is doubled; both can be
undone, and no control string is left inside.

A batch of turns is assembled at once: the lengths of all segments give their offsets, the
offsets give the scatter index of every byte, and headers and contents are copied into one
preallocated buffer, which becomes the Arrow column without a further copy.

Turns are formatted, and read back, where they are scanned; one row per turn is returned, so a
conversation may be of any length, and memory is bounded by a batch of turns. `in_order` then
puts conversations together by a sort inside the partitions of `conv_id`. The digests are
sequential hashes, carried from batch to batch: such a hash cannot be split, so what was read
back of one conversation passes through one task, which only hashes it.

Null roles and texts count as empty. Turns that share a number are ordered by role, then by
text; rows that repeat are repeated turns. A null conversation id is a conversation of its
own. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import ship, slices, text_buffer

CONTROLS = (b"<s>", b"</s>", b"[INST]", b"[/INST]")
OPEN, MIDDLE, CLOSE = b"<s>[INST] ", b" [/INST] ", b"</s>"
BACKSLASH = 0x5C
#: Role whose texts the loss is computed on.
LEARNED = "assistant"


def escaped(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The escaped texts as one byte array and their n + 1 offsets."""
    data, offsets = text_buffer(texts, close=b"\0")
    extra = (data == BACKSLASH).astype(np.int64)
    for control in CONTROLS:
        if len(data) < len(control):
            continue
        hit = np.ones(len(data) - len(control) + 1, bool)
        for i, byte in enumerate(control):
            hit &= data[i : len(data) - len(control) + 1 + i] == byte
        extra[: len(hit)] += hit  # the closing zero byte keeps hits inside a text
    real = np.ones(len(data), bool)
    real[offsets[1:] - 1] = False
    size = np.where(real, 1 + extra, 0)
    place = np.concatenate(([0], np.cumsum(size)))
    out = np.full(place[-1], BACKSLASH, np.uint8)
    out[place[:-1][real]] = data[real]
    return out, place[offsets]


def assembled(roles: pa.Array, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The formatted turns, and where each turn's content begins and ends in it, in bytes."""
    parts = [escaped(roles), escaped(texts)]
    n = len(roles)
    role_size, text_size = (np.diff(p[1]) for p in parts)
    fixed = [np.frombuffer(x, np.uint8) for x in (OPEN, MIDDLE, CLOSE)]
    sizes = np.column_stack(
        [np.full(n, len(OPEN)), role_size, np.full(n, len(MIDDLE)), text_size, np.full(n, len(CLOSE))]
    )
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    starts = ends - sizes
    total = int(ends[-1, -1]) if n else 0
    out = np.empty(total, np.uint8)
    for column, piece in zip((0, 2, 4), fixed):
        out[starts[:, column, None] + np.arange(len(piece))] = piece
    for column, (content, offsets) in zip((1, 3), parts):
        lengths = np.diff(offsets)
        out[np.arange(len(content)) + np.repeat(starts[:, column] - offsets[:-1], lengths)] = content
    edges = np.concatenate((starts[:, 0], [total])).astype(np.int64)
    formatted = pa.Array.from_buffers(
        pa.large_string(), n, [None, pa.py_buffer(edges), pa.py_buffer(out)]
    )
    return formatted, starts[:, 3] - starts[:, 0], ends[:, 3] - starts[:, 0]


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        roles, texts = batch.column("role"), batch.column("text")
        formatted, begin, end = assembled(roles, texts)
        learned = pa.array([r == LEARNED for r in roles.to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                formatted.cast(pa.string()),
                pa.array(begin),
                pa.array(end),
                learned,
            ],
            ["conv_id", "turn", "formatted", "content_begin", "content_end", "learned"],
        )


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn, in the partitions of `turns`.

    `formatted` is the turn's part of the conversation; the loss is on the bytes from
    `content_begin` to `content_end` of it where `learned` is true.
    """
    ship(turns.sparkSession)
    given = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return given.mapInArrow(
        _formatted,
        "conv_id bigint, turn bigint, formatted string, content_begin bigint, "
        "content_end bigint, learned boolean",
    )


_TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*)</s>", re.S)
_ESCAPE = re.compile(r"\\(\\)?")


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[1] or "", text)


def read_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    role, text = _TURN.fullmatch(formatted).groups()
    return unescape(role), unescape(text)


READ = (
    "conv_id bigint, turn bigint, role string, text string, masked string, learned boolean, "
    "chars bigint"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "formatted"):
        columns = ("formatted", "content_begin", "content_end", "learned")
        rows = []
        for formatted, begin, end, learned in zip(*(batch.column(c).to_pylist() for c in columns)):
            role, text = read_turn(formatted)
            masked = unescape(formatted.encode()[begin:end].decode()) if learned else text
            rows.append((role, text, None if masked == text else masked, len(formatted)))
        role, text, masked, chars = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                pa.array(role, pa.string()),
                pa.array(text, pa.string()),
                pa.array(masked, pa.string()),
                batch.column("learned"),
                pa.array(chars, pa.int64()),
            ],
            ["conv_id", "turn", "role", "text", "masked", "learned", "chars"],
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per formatted turn, with what its format says: role, text, length in characters.

    `masked` is the text under the loss mask of a `learned` turn; null if equal to `text`.
    """
    return formatted.mapInArrow(_read, READ)


def in_order(turns: DataFrame) -> DataFrame:
    """Turns that were read back, conversations together and in order inside each partition."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


class _Digest:
    """What is read back from one conversation, turn by turn."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, masked: str | None, learned: bool, chars: int) -> None:
        self.turns += 1
        self.chars += chars
        self.all.update(f"{role}\n{text}\n".encode())
        if learned:
            said = text if masked is None else masked
            self.loss_chars += len(said)
            self.loss.update(said.encode())

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.turns,
            self.all.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
    "loss_sha256 string, formatted_chars bigint"
)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in DIGEST.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    current = None
    for batch in slices(batches, "text"):
        done = []
        for conv, *turn in zip(
            *(
                batch.column(c).to_pylist()
                for c in ("conv_id", "role", "text", "masked", "learned", "chars")
            )
        ):
            if current is None or current.conv_id != conv:
                if current:
                    done.append(current.row())
                current = _Digest(conv)
            current.add(*turn)
        yield batch_of(done)
    if current:
        yield batch_of([current.row()])


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its formatted turns."""
    return in_order(read_back(formatted)).mapInArrow(_hashed, DIGEST)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text"
    )
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return digests(format_turns(turns.unionByName(probe)))
