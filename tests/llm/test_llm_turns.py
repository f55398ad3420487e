"""Conversation repair against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ladderlake.llm import turn_repair

TURNS = "conv_id bigint, turn bigint, role string, text string, place string, line string"
SHAPE = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


# --- the search -----------------------------------------------------------------------------


def cheapest(rows):
    """All edits with at most two insertions in a row; rows are (initial, must go, breaks off)."""
    found = []

    def walk(i, shape, cost, audit, inserted):
        if i == len(rows) and SHAPE.fullmatch(shape):
            found.append((cost, audit))
        if inserted < 2:
            for role in "ua":
                walk(i, shape + role, cost + 2, audit + "I", inserted + 1)
        if i < len(rows):
            initial, must_go, cut = rows[i]
            walk(i + 1, shape, cost + 3, audit + "D", 0)
            if not must_go:
                walk(i + 1, shape + initial, cost + cut, audit + "K", 0)
                for role in "ua":
                    walk(i + 1, shape + role, cost + 2 + cut, audit + "R", 0)

    walk(0, "", 0, "", 0)
    return min(found)


def coded(rows):
    return bytes(
        turn_repair.INITIALS.get(initial, 3)
        | (turn_repair.MUST_GO if must_go else 0)
        | (turn_repair.BREAKS_OFF if cut else 0)
        for initial, must_go, cut in rows
    )


ROW = st.one_of(
    st.tuples(st.sampled_from("suax"), st.just(False), st.booleans()),
    st.tuples(st.sampled_from("suax"), st.just(True), st.just(False)),
)


@settings(max_examples=40, deadline=None)
@given(st.lists(ROW, max_size=4))
def test_the_search_finds_the_cheapest_edits_and_the_least_audit(rows):
    assert turn_repair.repair(coded(rows)) == cheapest(rows)


def test_long_conversations_are_linear():
    rng = random.Random(5)
    rows = [(rng.choice("suax"), rng.random() < 0.2, False) for _ in range(50_000)]
    cost, audit = turn_repair.repair(coded(rows))
    assert sum(letter in "KRD" for letter in audit) == 50_000 and cost > 0


# --- whole conversations --------------------------------------------------------------------


def least(rows):
    """(cost, audit, result) by dynamic programming over whole prefixes."""
    def shape_of(state, role):
        order = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
        return order[state].get(role)

    def insertions(front):
        for _ in range(3):
            for state, (cost, audit, out) in list(front.items()):
                for role, name in (("u", "user"), ("a", "assistant")):
                    to = shape_of(state, role)
                    made = (cost + 2, audit + "I", (*out, f"{name}:"))
                    if to and (to not in front or made[:2] < front[to][:2]):
                        front[to] = made
        return front

    front = insertions({"": (0, "", ())})
    for role, text, must_go, cut in rows:
        after = {}

        def offer(state, made):
            if state is not None and (state not in after or made[:2] < after[state][:2]):
                after[state] = made

        for state, (cost, audit, out) in front.items():
            offer(state, (cost + 3, audit + "D", out))
            if must_go:
                continue
            offer(shape_of(state, role[:1]), (cost + cut, audit + "K", (*out, f"{role}:{text}")))
            for name in ("user", "assistant"):
                made = (cost + 2 + cut, audit + "R", (*out, f"{name}:{text}"))
                offer(shape_of(state, name[0]), made)
        front = insertions(after)
    return min((front[s] for s in ("", "a") if s in front), key=lambda f: f[:2])


def brute(turns):
    convs = {}
    for conv, turn, role, text in turns:
        rows = convs.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows.extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    for conv, rows in convs.items():
        def content(row):
            return hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).digest()

        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:1], len(r[1]), content(r)))
        counts, faulty, seen = dict.fromkeys(("blank", "duplicate", "truncated"), 0), [], set()
        for _, role, text in rows:
            tail = text.rstrip(SPACE)
            fault = (
                "blank" if not tail else "duplicate" if (role, text) in seen
                else "truncated" if tail[-1] not in ".!?" else None
            )
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            faulty.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, out = least(faulty)
        digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
        yield (conv, gaps, *counts.values(), illegal, cost, audit, digest)


COLUMNS = (
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
    "repaired_sha256",
)


def repaired(spark, turns):
    frame = spark.createDataFrame([(*t, "x", "y") for t in turns], TURNS)
    made = turn_repair.repairs(turn_repair.damaged(frame))
    return sorted(map(tuple, made.select(*COLUMNS).collect()), key=repr)


def test_given_conversations(spark, sf):
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    want = sorted(brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]), key=repr)
    made = turn_repair.query(spark, sf).select(*COLUMNS)
    assert sorted(map(tuple, made.collect()), key=repr) == want


def test_nulls_ties_repeats_and_odd_roles(spark):
    rng = random.Random(3)
    said = ["Yes.", "No", "", None, " \n", "Who?", "　", "x" * 100_000 + ".", "Yes.", "a\nb!"]
    roles = ["user", "assistant", "system", None, "", "tool", "User", "unknown"]
    turns = [
        (rng.choice([None, *range(40)]), rng.choice([None, 1, 2, 3, 3, 9, 10**6]),
         rng.choice(roles[: 3 if rng.random() < 0.7 else 8]), rng.choice(said))
        for _ in range(500)
    ]
    # One conversation with a third of all rows.
    turns += [(7, t, "user" if t % 2 else "assistant", f"{t % 11}.") for t in range(250)]
    assert repaired(spark, turns) == sorted(brute(turns), key=repr)


def test_no_rows_left_and_empty_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(spark, [(gone, 0, "user", "Hi.")]) == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    none = spark.createDataFrame([], TURNS)
    assert turn_repair.repairs(turn_repair.damaged(none)).count() == 0
