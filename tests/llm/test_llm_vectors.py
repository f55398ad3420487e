"""Hard-negative mining against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ladderlake.llm import hard_negatives as hn

ROWS = "vec_id bigint, embedding array<double>, label int, a_block string, score string, rank string"


def brute(rows):
    """Rows are (vec_id, vector, label); exact integers throughout."""
    taken = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(256 * x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        taken.append((vec_id, label, [math.floor(256 * x) for x in vector]))

    def ranked(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))

    out = []
    for at, (anchor, label, q) in enumerate(taken):
        if anchor is None or anchor % 50:
            continue
        scores = [
            (sum(a * b for a, b in zip(q, other)), vec_id, kind == label)
            for i, (vec_id, kind, other) in enumerate(taken) if i != at
        ]
        for p, positive, _ in ranked([s for s in scores if s[2]])[:5]:
            inside = [s for s in scores if not s[2] and 50 * p <= 100 * s[0] <= 95 * p]
            for rank, (n, negative, _) in enumerate(ranked(inside)[:3], 1):
                out.append((anchor, positive, rank, negative, p, n))
    return sorted(out, key=repr)


def made(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROWS).repartition(3)
    return sorted(map(tuple, hn.hard_negatives(frame).collect()), key=repr)


def clustered(rng, n, dims=6, spread=0.3):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [
        (i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.randrange(10)) for i in range(n)
    ]


def test_clusters(spark):
    rows = clustered(random.Random(1), 400)
    want = brute(rows)
    assert want and made(spark, rows) == want


def test_many_blocks_and_a_hot_label(spark, monkeypatch):
    """A third of all rows has one label; blocks of few rows, so that most pairs are pruned."""
    monkeypatch.setattr(hn, "BLOCK_BYTES", 0)
    monkeypatch.setattr(hn, "ANCHOR_BYTES", 0)
    rng = random.Random(2)
    rows = [(i, v, 3 if i % 3 else label) for i, v, label in clustered(rng, 1500)]
    assert made(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = clustered(rng, 150, dims=3)
    rows += [(None, [0.5, 0.5, 0.1], 2), (50, None, 1), (100, [1.0, None, 0.0], 1), (150, [1.0], None)]
    rows += [(200, [float("nan")], 1), (250, [float("inf")], 1), (300, [1e308], 1), (350, [], 4)]
    rows += [(400, [0.0, 0.0, 0.0], 5), (-50, [0.3] * 7, 6), (450, [0.2, 0.1], 6), (900, [0.25] * 3, 7)]
    rows += rows[:30]  # rows that repeat, anchors too
    assert made(spark, rows) == brute(rows)
    assert made(spark, []) == []


def test_sums_beyond_53_bits(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(0, 4e5) for _ in range(4)], i % 3) for i in range(120)]
    rows += [(1000 + i, [9e5, float(i)], 1) for i in range(5)]
    assert made(spark, rows) == brute(rows)


VECTOR = st.lists(st.floats(-3, 3, allow_nan=False), min_size=4, max_size=4)


@settings(max_examples=60, deadline=None)
@given(st.lists(VECTOR, min_size=1, max_size=6), st.lists(VECTOR, min_size=1, max_size=6), st.integers(0, 3))
def test_products_lie_within_their_bounds(left, right, directions):
    a, x = (hn.matrix([np.array(v) for v in vs], 4) for vs in (left, right))
    some = hn.far_apart(x, directions) if directions else np.zeros((0, 4))
    angles = [hn.angles_to(q, some) for q in (a, x)]
    low, high = hn.score_bounds(angles[0], hn.norms_of(a), angles[1], hn.norms_of(x))
    scores = hn.products(a, x)
    assert (low <= scores).all() and (scores <= high).all()


def test_the_filter_spares_scores_where_there_are_clusters():
    rng = random.Random(5)
    q = hn.matrix([np.array(v) for _, v, _ in clustered(rng, 600, dims=16, spread=0.05)], 16)
    angles = hn.angles_to(q, hn.far_apart(q))
    _, high = hn.score_bounds(angles, hn.norms_of(q), angles, hn.norms_of(q))
    floor = np.sort(hn.products(q, q), axis=1)[:, -6]
    assert (high >= floor[:, None]).mean() < 0.5


@pytest.mark.parametrize("most", [1, 10, 100])
def test_blocks_take_all_rows(most):
    counts = {(0, 0): 5, (0, 1): 250, (1, 0): 1, (2, 3): 99, (3, 0): 100}
    places, blocks = hn.dealt(counts, most)
    used = [b for first, parts in places.values() for b in range(first, first + parts)]
    assert set(used) == set(range(blocks)) and set(places) == set(counts)
    assert all(parts >= counts[key] / most for key, (_, parts) in places.items())
