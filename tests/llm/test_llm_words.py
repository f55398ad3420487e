"""Substring deduplication of words against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ladderlake.llm import super_kmers

DOCS = "doc_id bigint, text string, id string, th string, key string, words string, last string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, window=super_kmers.WINDOW):
    words = [(doc_id, WORD.findall(text or "")) for doc_id, text in docs]
    least = {}
    for doc_id, seen in words:
        for a in range(len(seen) - window + 1):
            key = tuple(seen[a : a + window])
            if doc_id is not None:
                least[key] = min(least.get(key, doc_id), doc_id)
    for doc_id, seen in words:
        gone = set()
        for a in range(len(seen) - window + 1):
            if doc_id is not None and least[tuple(seen[a : a + window])] < doc_id:
                gone.update(range(a, a + window))
        kept = " ".join(w for i, w in enumerate(seen) if i not in gone)
        yield (doc_id, len(seen), len(gone), hashlib.sha256(kept.encode()).hexdigest())


def made(spark, docs):
    frame = spark.createDataFrame([(*d, "a", "b", "c", "d", "e") for d in docs], DOCS)
    return sorted(map(tuple, super_kmers.report(frame.repartition(4)).collect()), key=repr)


def planted(rng, n=60):
    """Documents that share passages, whole texts, or all but a word."""
    vocabulary = [f"w{i}" for i in range(400)] + ["日本", "É", "x\x1cy", "\x85"]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    docs = []
    for i in range(n):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([0, 10, 49, 50, 51, 200]))]
        if i % 3 == 0:
            cut = rng.randint(0, 25)
            at = rng.randint(0, len(text))
            text[at:at] = passage[cut : cut + rng.randint(45, 70)]
        if i % 7 == 0 and docs:
            text = docs[rng.randrange(len(docs))][1].split() + text[:5]
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(text)))
    return docs


def test_passages_between_documents(spark):
    rng = random.Random(1)
    docs = planted(rng)
    got = made(spark, docs)
    assert got == sorted(brute(docs), key=repr)
    assert sum(r[2] for r in got) > 1000


def test_edges(spark):
    run = "word " * 3000
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, run), (5, run + "end"), (5, run), (6, "x" * 300_000),
        (None, run), (None, run), (7, run), (7, run), (8, " ".join(map(str, range(60)))),
        (9, " ".join(map(str, range(59))) + " z"), (-3, " ".join(map(str, range(1, 60)))),
    ]
    assert made(spark, docs) == sorted(brute(docs), key=repr)
    assert super_kmers.report(spark.createDataFrame([], DOCS)).count() == 0


def test_words_that_stay(spark):
    run = " ".join(map(str, range(50)))
    frame = spark.createDataFrame([(1, run), (2, f"a {run}  b")], "doc_id bigint, text string")
    assert sorted(map(tuple, super_kmers.removed(frame).collect())) == [(1, run), (2, "a b")]


def test_long_texts_go_in_pieces(spark, monkeypatch):
    rng = random.Random(4)
    words = [str(rng.randint(0, 10**6)) for _ in range(3000)]
    whole = " ".join(words)
    monkeypatch.setattr(super_kmers, "PIECE_BYTES", 700)
    covered = set()
    for before, piece in super_kmers.pieces(whole):
        some = piece.decode().split()
        assert words[before : before + len(some)] == some
        covered.update(range(before, before + len(some) - 49))
    assert covered == set(range(2951))
    schema = ["id", "th", "text"]
    found = lambda text: [
        (r["start"], r["windows"]) for b in super_kmers._found(
            iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], schema)])
        ) for r in b.to_pylist()
    ]
    assert {s + i for s, n in found(whole) for i in range(n)} == set(range(2951))


def test_hot_minimisers_are_unpacked(spark, monkeypatch):
    """With a bound of few windows most minimisers go the other way; the result is the same."""
    docs = planted(random.Random(2))
    for bound in (0, 60):
        monkeypatch.setattr(super_kmers, "HOT_WINDOWS", bound)
        assert made(spark, docs) == sorted(brute(docs), key=repr)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 5), st.lists(st.sampled_from("ab"), min_size=1, max_size=20)),
        min_size=1, max_size=8,
    ),
    st.integers(1, 6),
)
def test_windows_are_told_apart_by_sorting(rows, window):
    ids = np.array([i for i, _ in rows])
    least, first = super_kmers.least_ids(pa.array([" ".join(w) for _, w in rows]), ids, window)
    for i, (_, words) in enumerate(rows):
        own = [tuple(words[a : a + window]) for a in range(len(words) - window + 1)]
        want = [
            min(j for j, other in rows for a in range(len(other) - window + 1)
                if tuple(other[a : a + window]) == w)
            for w in own
        ]
        assert least[first[i] : first[i + 1]].tolist() == want


@pytest.mark.parametrize("run", [1, 255, 256, 257, 1000])
def test_runs_hold_every_window_once(run):
    hashes = np.zeros(run + 49, np.uint64)
    _, start, windows, _ = super_kmers.runs_of_windows(hashes, np.array([0, run + 49]))
    assert [s + i for s, n in zip(start, windows) for i in range(n)] == list(range(run))


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = sorted(brute([tuple(r) for r in docs.collect()]), key=repr)
    got = sorted(map(tuple, super_kmers.query(spark, sf).collect()), key=repr)
    assert got == want
