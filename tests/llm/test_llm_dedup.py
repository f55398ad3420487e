"""Exact, near and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ladderlake.llm import exact_dedup, simhash, suffix_dedup
from ladderlake.llm.common import text_buffer

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, fp string"


def documents(spark, texts):
    """A table with further columns whose names the operators use themselves."""
    rows = [(i, t, "en", None, 1, 0.5, "x") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


EDGE = [
    (1, "a  b"),
    (2, "a\tb"),
    (2, "a\tb"),
    (3, "a b "),
    (4, None),
    (5, ""),
    (None, "a b"),
    (None, "lone"),
    (6, "word " * 40_000),
    (7, "é x"),
    (8, "é x"),
]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_classes_of_edge_cases(spark):
    groups = defaultdict(list)
    for doc, text in EDGE:
        groups[normal(text)].append(doc)
    want = []
    for doc, text in EDGE:
        own = groups[normal(text)]
        ids = [d for d in own if d is not None]
        keep = min(ids) if ids else None
        digest = hashlib.sha256(normal(text).encode()).hexdigest()
        want.append((doc, keep, len(own), doc == keep, digest))
    assert by_id(exact_dedup.classes(documents(spark, EDGE))) == sorted(want, key=repr)


def test_exact_bytes_part_texts_whose_hashes_collide(spark):
    texts = [(i, f"text {i % 7}") for i in range(40)]
    docs = documents(spark, texts)
    weak = exact_dedup.classes(docs, digest=lambda t: F.lit(1))
    assert by_id(weak) == by_id(exact_dedup.classes(docs))


def test_exact_keep_first_keeps_columns_and_one_row_of_each_group(spark):
    kept = exact_dedup.keep_first(documents(spark, EDGE))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 6, 7, 8]
    assert [r.text for r in kept.collect() if r.doc_id is None] == ["lone"]
    assert exact_dedup.keep_first(documents(spark, [])).count() == 0


def simple_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_are_those_of_the_definition():
    rng = random.Random(1)
    words = ["the", "Aé", "x" * 40, "foo", "ÀB", "z", "longerword", " "]
    texts = [
        " \n".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + rng.choice(["", " "])
        for _ in range(300)
    ] + [None, "", " \t", "one", "one two", "a" * 100_000]
    assert list(map(int, simhash.fingerprints(pa.array(texts)))) == [simple_fingerprint(t) for t in texts]


def planted_prints(seed=0, groups=200, near=12):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, groups, dtype=np.uint64)
    out = [base]
    for _ in range(near):
        for _ in range(2):
            base = base ^ (np.uint64(1) << rng.integers(0, 64, groups, dtype=np.uint64))
        out.append(base)
    return np.unique(np.concatenate(out))


def test_tree_finds_every_pair():
    points = planted_prints()
    distance = np.bitwise_count(points[:, None] ^ points[None])
    want = set(zip(*(x.tolist() for x in np.nonzero(np.triu(distance <= 2, 1)))))
    found = set()
    for a, b in simhash.pairs_within(points, 2, block=32):
        found |= {(min(x), max(x)) for x in zip(a.tolist(), b.tolist())}
    assert found == want


def test_routing_brings_every_linked_pair_to_one_shard():
    points = planted_prints(3)
    nodes = simhash.grow(points[::5], 16)
    assert len(nodes) > 5
    rows, shard = simhash.route(points, nodes)
    visits = defaultdict(set)
    for r, s in zip(rows.tolist(), shard.tolist()):
        visits[r].add(s)
    assert set(visits) == set(range(len(points)))
    distance = np.bitwise_count(points[:, None] ^ points[None])
    for a, b in zip(*np.nonzero(np.triu(distance <= 2, 1))):
        assert visits[int(a)] & visits[int(b)]


def union(pairs, items):
    parent = {i: i for i in items}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in items}


@pytest.mark.parametrize("shape", ["random", "chain", "star"])
def test_components(spark, shape):
    rng = random.Random(5)
    pairs = {
        "random": [(rng.randint(-40, 40), rng.randint(-40, 40)) for _ in range(35)],
        "chain": [(i, i + 1) for i in range(30)],
        "star": [(0, i) for i in range(1, 60)] + [(99, 98)],
    }[shape]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    want = union(pairs, {x for p in pairs for x in p})
    touched = {x for a, b in pairs if a != b for x in (a, b)}
    roots = {want[x] for x in touched}
    assert {k: v for k, v in got.items() if k != v} == {x: want[x] for x in touched - roots}


def test_linked_components_of_planted_fingerprints(spark):
    points = planted_prints(7, groups=60, near=6)
    ids = list(range(1_000, 1_000 + len(points)))
    random.Random(2).shuffle(ids)
    rows = [(i, int(p)) for i, p in zip(ids, points.view(np.int64))] + [(5, int(points.view(np.int64)[0]))]
    got = {r.doc_id: r.component_id for r in simhash.linked(spark.createDataFrame(rows, "doc_id bigint, fp bigint")).collect()}
    close = [
        (a, b)
        for a, b in zip(*(x.tolist() for x in np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None]) <= 2, 1))))
    ]
    root = union(close, range(len(points)))
    members = defaultdict(list)
    for place, i in enumerate(ids):
        members[root[place]].append(i)
    members[root[0]].append(5)
    want = {i: min(own) for own in members.values() for i in own}
    assert got == want


def test_near_duplicates_of_edge_cases(spark):
    got = by_id(simhash.near_duplicates(documents(spark, EDGE)))
    prints = [(d, f"{simple_fingerprint(t):016x}") for d, t in EDGE]
    assert sorted((r[:2] for r in got), key=repr) == sorted(prints, key=repr)
    assert {r[2] for r in got if r[0] in (4, 5)} == {4}  # no word: fingerprint zero, linked
    kept = simhash.keep_one(documents(spark, EDGE))
    assert len(kept.columns) == 7 and {r.doc_id for r in kept.collect()} >= {None, 1, 4, 6}
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


BASE_TEXT = " ".join(f"word{i}" for i in range(80))
REPEATS = [
    (1, BASE_TEXT),
    (2, BASE_TEXT),
    (2, "an entirely other text stands here under the same id"),
    (3, "a row that was loaded twice"),
    (3, "a row that was loaded twice"),
    (None, "without an id but twice"),
    (None, "without an id but twice"),
    (None, BASE_TEXT),
    (None, None),
    (None, ""),
]


@pytest.mark.parametrize("stage", [exact_dedup.keep_first, simhash.keep_one])
def test_stages_decide_by_row_and_leave_one_of_repeats(spark, stage):
    kept = stage(documents(spark, REPEATS))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    got = sorted(((r.doc_id, r.text or "") for r in kept.collect()), key=repr)
    want = [REPEATS[i] for i in (0, 2, 3, 5)] + [(None, "")]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("stage", [exact_dedup.keep_first, simhash.keep_one])
def test_which_of_repeats_stays_does_not_depend_on_their_order(spark, stage):
    rows = [(5, "one text", "en", n, n, float(n or 0), "x") for n in (None, 1, 2, 3)]
    schema = DOCS.replace("source string", "source int")
    one = [tuple(r) for r in stage(spark.createDataFrame(rows, schema)).collect()]
    assert len(one) == 1
    assert [tuple(r) for r in stage(spark.createDataFrame(rows[::-1], schema)).collect()] == one


# --- suffix arrays --------------------------------------------------------------------------


@pytest.mark.parametrize("length", [5, 8, 13, 40])
def test_family_marks_what_brute_force_counts(length):
    rng = random.Random(length)
    for trial in range(8):
        letters = b"ab\x00c"[: 2 + trial % 3]
        parts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 150))) for _ in range(25)]
        parts += [parts[0] + parts[1], parts[2][5:] + b"zz" + parts[3]]
        count = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        for part, runs in zip(parts, suffix_dedup.repeated_runs(parts, length, 200)):
            got = {i for a, b in runs for i in range(a, b)}
            assert got == {i for i in range(len(part) - length + 1) if count[part[i : i + length]] > 1}


def test_levels_stay_logarithmic():
    rng = random.Random(0)
    family = suffix_dedup.Family(20)
    for _ in range(40):
        family.add([bytes(rng.randrange(256) for _ in range(200))])
    assert sum(map(len, family.levels)) == 40 * 181
    assert len(family.levels) <= 6


def test_segments_cover_each_window_once_and_equal_windows_share_a_key():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(0, 1500))) for _ in range(15)]
    for period in (300, 368, 369, 370, 399, 400):
        unit = "".join(rng.choice("abcdefgh") for _ in range(period))
        texts += [unit * 3, texts[0] + unit + unit + unit[:99]]
    texts += ["xy" * 700, "", None, "a" * 399, "a" * 400, texts[0] + texts[1]]
    data, offsets = text_buffer(pa.array(texts))
    seen, keys = Counter(), {}
    for doc, start, windows, key, twin in zip(*suffix_dedup.segments(data, offsets)):
        own = [data[i : i + 400].tobytes() for i in range(start, start + windows)]
        assert twin or len(set(own)) == len(own)
        for i in range(start, start + windows):
            seen[(doc, i)] += 1
            assert offsets[doc] <= i and i + 400 < offsets[doc + 1]
            assert keys.setdefault(data[i : i + 400].tobytes(), key) == key
    assert set(seen.values()) == {1}
    assert len(seen) == sum(max(0, len((t or "").encode()) - 399) for t in texts)


def brute_report(texts, length=400):
    data = [(d, (t or "").encode()) for d, t in texts]
    count = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for doc, b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        removed = np.cumsum(gone[:-1]) > 0
        spans = int(np.sum(np.diff(np.concatenate(([0], removed.astype(int)))) == 1))
        kept = np.frombuffer(b, np.uint8)[~removed].tobytes()
        out.append((doc, len(b), int(removed.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def substring_texts():
    rng = random.Random(9)
    fresh = lambda n: "".join(rng.choice("abcdefghijklmnop éß") for _ in range(n))
    passage, exact = fresh(700), fresh(400)[:390]
    exact += "q" * (400 - len(exact.encode()))
    texts = [(i, fresh(rng.randint(0, 900)) + passage[: 300 + 40 * i] + fresh(rng.randint(0, 500))) for i in range(12)]
    texts += [(20, fresh(50) + exact), (21, exact + fresh(30)), (22, exact[:-1] + "z")]
    unit = fresh(369)
    texts += [(24, unit * 3), (25, fresh(99) + unit[::-1] * 2), (26, fresh(380) * 3)]
    texts += [(30, fresh(600)), (31, "ab" * 600), (32, "a" * 399), (33, "a" * 400), (34, "a" * 401)]
    body = fresh(1_500)
    texts += [(40, body), (41, body), (42, body[:700] + "X" + body[700:]), (42, body), (42, body)]
    return texts + [(None, body), (None, None), (50, ""), (51, "short"), (52, fresh(20_000))]


@pytest.mark.parametrize("hot", [4 << 20, 2_000, 0])
def test_removed_stretches_are_those_of_brute_force(spark, monkeypatch, hot):
    """With small bounds on a key's bytes, keys are resolved window by window instead."""
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3_000)
    texts = substring_texts()
    got = by_id(suffix_dedup.report(documents(spark, texts)))
    assert got == brute_report(texts)
    assert sum(r[2] for r in got) > 5_000


@pytest.mark.parametrize("width", [1, 7, 32])
def test_pieces_put_equal_windows_into_one_group(width):
    rng = random.Random(width)
    fresh = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = fresh(420)
    texts = [fresh(rng.randint(0, 300)) + passage + fresh(rng.randint(0, 300)) for _ in range(12)]
    texts += ["ab" * 500, "x" * 700, fresh(90) * 9]
    data, offsets = text_buffer(pa.array(texts))
    group, windows = {}, 0
    for _, start, count, key, _ in zip(*suffix_dedup.segments(data, offsets)):
        segment = data[start : start + count + 399].tobytes()
        first, runs, core = suffix_dedup.pieces_of(segment, key, width)
        assert np.array_equal(np.cumsum(runs)[:-1], first[1:]) and runs.sum() == count
        for a, n, c in zip(first, runs, core):
            assert n <= width
            shared = segment[c : c + 400 - width + 1]
            assert len(shared) == 401 - width
            own = [segment[i : i + 400] for i in range(a, a + n)]
            assert len(set(own)) == n and all(shared in w for w in own)
            assert all(group.setdefault(w, (key, shared)) == (key, shared) for w in own)
            windows += n
    assert len(group) < windows


def hot_segments(texts):
    """Rows (key, da, db, bytes) of all segments of texts, as a hot key brings them."""
    data, offsets = text_buffer(pa.array(texts))
    found = zip(*suffix_dedup.segments(data, offsets))
    parts = [(int(key.view(np.int64)), data[a : a + n + 399].tobytes()) for _, a, n, key, _ in found]
    return [(key, 0, i, part) for i, (key, part) in enumerate(parts)]


@pytest.mark.parametrize("width", [1, 32])
def test_a_piece_that_recurs_in_its_segment_is_one_row(width):
    rng = random.Random(width)
    texts = ["one and the same line\n" * n for n in (60, 61, 75)]
    texts.append("".join(rng.choice("abcdefgh") for _ in range(900)))
    names = ["key", "da", "db", "bytes"]
    given = hot_segments(texts)
    batch = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in given])
    rows = [r for out in suffix_dedup._split(width, iter([batch])) for r in out.to_pylist()]
    assert len({(r["db"], r["pa"], r["pb"]) for r in rows}) == len(rows)
    windows = Counter((r["db"], p + i) for r in rows for p in r["places"] for i in range(r["windows"]))
    assert windows == Counter((i, w) for _, _, i, part in given for w in range(len(part) - 399))


def shuffled_rows(df):
    """The rows that each exchange of the executed plan has sent."""
    df.collect()
    todo, sent = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            sent.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sent


def test_copies_of_a_piece_are_counted_before_a_group_is_dealt(spark, monkeypatch):
    """Many segments with one passage: a task sends a row per distinct piece, not per segment."""
    rng = random.Random(11)
    fresh = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = fresh(800)
    segments = hot_segments([fresh(50) + passage + fresh(50) for _ in range(200)])
    hot = spark.createDataFrame(segments, "key bigint, da bigint, db bigint, bytes binary").coalesce(2)
    pieces = hot.mapInArrow(partial(suffix_dedup._split, 32), suffix_dedup.PIECE)
    rows, distinct = pieces.count(), pieces.select("key", "core", "pa", "pb").distinct().count()
    assert rows > 3 * distinct
    cut, durable = [], suffix_dedup.durable
    monkeypatch.setattr(suffix_dedup, "durable", lambda df: cut.append(df) or durable(df))
    suffix_dedup._split_runs(hot, (32,))
    sent = [n for df in cut for n in shuffled_rows(df)]
    assert len(sent) > 3 and 0 < max(sent) <= 2 * distinct


def test_pieces_of_a_group_that_stays_hot_are_dealt_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 6_000)
    rng = random.Random(12)
    fresh = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = fresh(405)  # holds a core, with other bytes around it in each text
    segments = hot_segments([fresh(40) + passage + fresh(40) for _ in range(160)])
    hot = spark.createDataFrame(segments, "key bigint, da bigint, db bigint, bytes binary")
    given, split = [], suffix_dedup._split_runs
    monkeypatch.setattr(suffix_dedup, "_split_runs", lambda df, w: given.append(df) or split(df, w))
    conf = {"adaptive.coalescePartitions.enabled": "false", "autoBroadcastJoinThreshold": "-1"}
    try:
        for name, value in conf.items():
            spark.conf.set(f"spark.sql.{name}", value)
        suffix_dedup._split_runs(hot, suffix_dedup.WIDTHS)
        (over,) = given[1:]
        sizes = [n for _, n in over.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name in conf:
            spark.conf.unset(f"spark.sql.{name}")
    assert sum(sizes) >= 160 and max(sizes) <= sum(sizes) / 3


def test_hot_keys_with_cores_that_stay_hot(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 6_000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3_000)
    rng = random.Random(6)
    fresh = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    texts = []
    for size in (372, 390, 400, 415, 520):  # cores are shared, windows partly or not at all
        passage = fresh(size)
        texts += [fresh(40) + passage + fresh(40) for _ in range(30)]
    texts = list(enumerate(texts))
    got = by_id(suffix_dedup.report(documents(spark, texts)))
    assert got == brute_report(texts)
    assert sum(r[2] > 0 for r in got) >= 90


def test_long_texts_are_handled_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 700)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdé") for _ in range(n)) for n in (0, 399, 400, 1_098, 1_099, 5_000)] + [None]
    seen = Counter()
    for row, start, windows, *_ in (x for part in suffix_dedup._segments_of(texts) for x in zip(*part)):
        seen.update((row, i) for i in range(start, start + windows))
    sizes = [len((t or "").encode()) for t in texts]
    assert seen == Counter((r, i) for r, n in enumerate(sizes) for i in range(max(0, n - 399)))


def test_removed_texts_and_empty_table(spark):
    texts = [(1, "é" * 300 + "tail"), (2, "head" + "é" * 300)]
    got = dict(map(tuple, suffix_dedup.removed(documents(spark, texts)).collect()))
    assert got == {1: "tail", 2: "head"}
    assert suffix_dedup.report(documents(spark, [])).count() == 0
