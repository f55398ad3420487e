"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts every text where its content says so, so passages that
documents share are cut alike. A chunk is encoded once per task and looked up afterwards.
Joins are then repaired: a chunk's ids are trusted only between its first and its last
*firm* place, which is where white space follows something else or, in scripts without
spaces, a mark or punctuation follows a letter. Whatever stands on the left, the byte-level
pattern starts a new piece there, and no piece reaches across it. What
lies between the last firm place of one chunk and the first of the next is encoded again as
one string. If a chunk has none, that string grows over further chunks until both its ends
are firm or the text ends; so the ids agree exactly with those of the whole text.

Decoding joins the vocabulary's bytes and reads them as UTF-8, bad bytes replaced.

The dictionary of chunks is bounded (`DICTIONARY_IDS`); when it is full it starts afresh.
It lives in the task: sharing it between tasks would shuffle texts and ids, which costs more
than encoding a chunk once per task. Ids do not depend on what the dictionary holds.

Null texts are empty texts; they have no ids and decode to the empty text. A null id keeps
its row. Very long texts are cut like any other; only one slice of texts is in memory at a
time. Repeated rows get equal results. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import append, text_buffer

#: The byte-level pattern of the vocabulary and its special token (fixed values).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"

#: A chunk ends where the rolling hash has this many zero bits: 1 KB on average.
CUT_BITS = 10
#: Bytes that the rolling hash sees.
WINDOW = 32
#: Ids that the dictionary of chunks holds at most, per task.
DICTIONARY_IDS = 4_000_000

#: Letters of scripts without spaces, and marks or punctuation of theirs (fixed ranges).
_LETTERS = r"\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\u0e01-\u0e2e"
_OTHERS = r"\u3001\u3002\uff0c\uff0e\uff01\uff1f\uff1a\uff1b\u300c-\u300f\uff08\uff09\u0e31\u0e34-\u0e3a\u0e47-\u0e4e"
#: Places that no piece reaches across: white space after something else, and a mark or
#: punctuation after a letter of those scripts, as no piece goes on behind its letters. All
#: sides are narrower than the pattern's own classes, so they hold in every flavour of them,
#: and none lies within the special token.
FIRM = re.compile(rf"(?<=\S)(?=[ \t\n\r\f\v])|(?<=[{_LETTERS}])(?=[{_OTHERS}])")
_LAST_FIRM = re.compile(rf".*(?:\S(?=[ \t\n\r\f\v])|[{_LETTERS}](?=[{_OTHERS}]))", re.S)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as source:
            given = json.load(source)
        alphabet = byte_of_char()
        vocabulary = given["model"]["vocab"]
        special = {t["content"]: t["id"] for t in given["added_tokens"]}
        ranks = {
            bytes(alphabet[c] for c in token): number
            for token, number in vocabulary.items()
            if token not in special
        }
        self.encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.special = set(special)
        self.bytes = {number: token for token, number in ranks.items()}
        self.bytes |= {number: token.encode() for token, number in special.items()}
        self.chunks: dict[str, tuple[int, int, list[int], str, str] | None] = {}
        self.held = 0

    def plain(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special=self.special, disallowed_special=())

    def chunk(self, text: str) -> tuple[list[int], str, str] | None:
        """(ids between the first and last firm place, what stands before, what after).

        None for a chunk without a firm place.
        """
        if text in self.chunks:
            return self.chunks[text]
        first = FIRM.search(text)
        known = None
        if first:
            begin = first.start()
            end = _LAST_FIRM.match(text).end()
            known = (self.plain(text[begin:end]), text[:begin], text[end:])
        if self.held > DICTIONARY_IDS:
            self.chunks.clear()
            self.held = 0
        self.chunks[text] = known
        self.held += len(text) // 2 + 8
        return known

    def encode(self, chunks: list[str]) -> list[int]:
        """The ids of the text that the chunks make up."""
        ids: list[int] = []
        open_: list[str] = []
        for text in chunks:
            known = self.chunk(text)
            if known is None:
                open_.append(text)
                continue
            inner, before, after = known
            # A place that is firm inside a chunk is firm in the text as well.
            open_.append(before)
            ids += self.plain("".join(open_))
            ids += inner
            open_ = [after]
        return ids + self.plain("".join(open_))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places after which a chunk ends, by a hash of the last WINDOW bytes.

    A place lies before a byte that starts a character.
    """
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        span = 1
        while span < WINDOW:
            factor = np.uint64(pow(0xD6E8FEB86659FD93, span, 1 << 64))
            wider = h.copy()
            wider[span:] += h[: max(len(h) - span, 0)] * factor
            h = wider
            span *= 2
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    hit = np.flatnonzero((h >> np.uint64(64 - CUT_BITS)) == 0) + 1
    hit = hit[hit < len(data)]
    return hit[(data[hit] & 0xC0) != 0x80]


def chunked(texts: pa.Array) -> list[list[str]]:
    """The chunks of every text."""
    data, offsets = text_buffer(texts, close=b"\n")
    cuts = cut_places(data)
    out = []
    for i in range(len(offsets) - 1):
        begin, end = int(offsets[i]), int(offsets[i + 1]) - 1
        inner = cuts[np.searchsorted(cuts, begin, "right") : np.searchsorted(cuts, end)]
        places = [begin, *inner.tolist(), end]
        out.append([data[a:b].tobytes().decode() for a, b in zip(places, places[1:])])
    return out


def hexdigest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(
    docs: DataFrame,
    vocabulary: str | None = None,
    text: str = "text",
    keep: list[str] | None = None,
    name: str = "ids",
) -> DataFrame:
    """`keep` (all columns if not given) and the ids of each text."""
    path = vocabulary or default_vocabulary()

    def compute(texts: pa.Array) -> list[pa.Array]:
        own = codec(path)
        return [pa.array([own.encode(chunks) for chunks in chunked(texts)], pa.list_(pa.int32()))]

    return append(docs, compute, f"`{name}` array<int>", text, keep)


def decoded(
    rows: DataFrame, vocabulary: str | None = None, ids: str = "ids", name: str = "decoded"
) -> DataFrame:
    """All columns and the text that the ids stand for. Null ids are no ids."""
    path = vocabulary or default_vocabulary()
    names = [*rows.columns, name]
    schema = rows.withColumn(name, F.lit("")).schema

    def run(batches):
        own = codec(path)
        for batch in batches:
            texts = [own.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return rows.mapInArrow(run, schema)


def _digests(path: str) -> Callable[[pa.Array], list[pa.Array]]:
    def compute(texts: pa.Array) -> list[pa.Array]:
        own = codec(path)
        sizes, of_ids, of_text = [], [], []
        for chunks in chunked(texts):
            ids = own.encode(chunks)
            sizes.append(len(ids))
            of_ids.append(hexdigest(",".join(map(str, ids))))
            of_text.append(hexdigest(own.decode(ids)))
        return [pa.array(sizes, pa.int64()), pa.array(of_ids), pa.array(of_text)]

    return compute


def digests(
    docs: DataFrame, vocabulary: str | None = None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Encodes, decodes and digests in one pass, so that no ids are written between.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return append(
        narrow,
        _digests(vocabulary or default_vocabulary()),
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
        keep=["doc_id"],
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
