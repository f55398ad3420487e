"""Conversation structure repair: depth-first branch and bound over edits of the turns.

A well-formed conversation has the role initials `(s?(ua)+)?`. Each row is kept (0), given the
role user or assistant (2) or deleted (3), and an empty turn of either role can be inserted
anywhere (2). Rows that are blank or repeat an earlier row of the conversation must go; a row
whose text breaks off costs 1 if it stays. The cheapest edits win, of equally cheap ones those
whose initials (K, R, D, I, in order) are least in ASCII order.

The search (`repair`) is per conversation: an explicit stack of prefixes, a lower bound for
every suffix and state, the incumbent (cost, audit), and per node the cheapest prefix that got
there. Children are visited in ASCII order, so of two equally cheap prefixes of a node the
first visited has the lesser audit and dominates: equally cheap prefixes of one node never
continue each other, since every further letter there is an insertion, which costs. The bounds
leave audits out of account but are otherwise tight, so a branch is cut as soon as it cannot
be as cheap as the best; the search is linear in the rows and ends with a proof of optimality.

Only what the search needs is brought together in one task per conversation, and streamed:
flags and digests of rows, no texts. Rows that repeat within a turn are one row with a count,
the first turn of each text is an aggregate with a map-side combine. The edits then go back to
the texts by row digest, an equi-join, and the digest of the repaired conversation, which the
contract makes sequential, streams its lines in order, a batch at a time.

Null roles and texts are one space, and so are null ids and turns in the damage key; rows of a
null conversation are one conversation, null turns come first. Rows of one turn are ordered by
the role's initial, then by a digest (the contract leaves that open). Rows that repeat are
rows of their own: the later ones are duplicates. A conversation of which no row is left has
zeros, an empty audit and the digest of the empty string. An empty table gives an empty
result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ladderlake.llm.common import durable, ship, slices

#: White space of the contract, as characters to trim.
SPACES = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of keeping a row whose text breaks off.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: A row for the search: its initial (0 s, 1 u, 2 a, 3 other), and flags.
INITIALS = {"s": 0, "u": 1, "a": 2}
MUST_GO, BREAKS_OFF = 4, 8

#: States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn of each initial, None where it does not fit.
AFTER = (
    (SYSTEM, USER, None, None),
    (None, USER, None, None),
    (None, None, ASSISTANT, None),
    (None, USER, None, None),
)
#: The only state that an insertion or a new role can lead to.
NEXT = (USER, USER, ASSISTANT, USER)
ENDS = (START, ASSISTANT)
_NEVER = 1 << 40


# --- the search -----------------------------------------------------------------------------


def suffix_bounds(rows: bytes) -> list[tuple[int, int, int, int]]:
    """The least cost from before row i in each state to a well-formed end, for i = 0..n."""

    def inserted(costs: list[int]) -> tuple[int, int, int, int]:
        for _ in range(2):
            costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
        return tuple(costs)

    least, after = 0, inserted([0, _NEVER, _NEVER, 0])
    bounds = [after]
    known: dict[tuple, tuple] = {}  # few: costs of states differ by a bounded amount
    for row in reversed(rows):
        if (row, after) not in known:
            costs = [DELETE + c for c in after]
            if not row & MUST_GO:
                stays = TRUNCATED if row & BREAKS_OFF else 0
                for state in range(4):
                    costs[state] = min(costs[state], stays + REROLE + after[NEXT[state]])
                    to = AFTER[state][row & 3]
                    if to is not None:
                        costs[state] = min(costs[state], stays + after[to])
            costs = inserted(costs)
            low = min(costs)
            known[row, after] = low, tuple(c - low for c in costs)
        low, after = known[row, after]
        least += low
        bounds.append(tuple(least + c for c in after))
    bounds.reverse()
    return bounds


def repair(rows: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of the rows, ties to the least audit."""
    n = len(rows)
    bounds = suffix_bounds(rows)
    best, audit = bounds[0][START], None
    cheapest = [_NEVER] * (4 * (n + 1))
    letters, parents = [""], [0]
    stack = [(0, START, 0, 0)]  # row, state, cost, prefix
    while stack:
        i, state, cost, prefix = stack.pop()
        if cost + bounds[i][state] > best or cheapest[4 * i + state] <= cost:
            continue
        cheapest[4 * i + state] = cost
        if i == n and state in ENDS:
            found = []
            while prefix:
                found.append(letters[prefix])
                prefix = parents[prefix]
            whole = "".join(reversed(found))
            if audit is None or (cost, whole) < (best, audit):
                best, audit = cost, whole
            continue
        children = [("I", i, NEXT[state], cost + INSERT)]
        if i < n:
            row = rows[i]
            children.insert(0, ("D", i + 1, state, cost + DELETE))
            if not row & MUST_GO:
                stays = cost + (TRUNCATED if row & BREAKS_OFF else 0)
                to = AFTER[state][row & 3]
                if to is not None:
                    children.append(("K", i + 1, to, stays))
                children.append(("R", i + 1, NEXT[state], stays + REROLE))
        for letter, at, to, paid in reversed(children):
            if paid + bounds[at][to] <= best:
                letters.append(letter)
                parents.append(prefix)
                stack.append((at, to, paid, len(letters) - 1))
    return best, audit


# --- rows and their faults --------------------------------------------------------------------


def _text_of(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: the contract's damage, by crc32 of `conv_id:turn`.

    A dropped row stays with no copies, so that its conversation is still known.
    """
    key = F.concat(_text_of(F.col("conv_id")), F.lit(":"), _text_of(F.col("turn")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = _text_of(F.col("role")), _text_of(F.col("text"))
    return turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def identified(rows: DataFrame) -> DataFrame:
    """`content` names role and text, `row_id` conversation, turn, role and text."""
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    place = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("conv_id", "turn")]
    return rows.withColumn("content", F.unhex(content)).withColumn(
        "row_id", F.unhex(F.sha2(F.concat_ws("|", *place, F.hex("content")), 256))
    )


def flagged(rows: DataFrame) -> DataFrame:
    """One row per distinct row, without its text: what the search needs of it.

    `first` is true in the first turn that has this role and text.
    """
    tail = F.rtrim("text", F.lit(SPACES))
    facts = (
        identified(rows)
        .select(
            "conv_id", "turn", "row_id", "content", "copies",
            F.substring("role", 1, 1).alias("initial"),
            F.length("role").alias("role_size"),
            (F.length(tail) == 0).alias("blank"),
            (~F.substring(tail, -1, 1).isin(".", "!", "?")).alias("breaks_off"),
        )
        .groupBy(
            "conv_id", "turn", "row_id", "content", "initial", "role_size", "blank", "breaks_off"
        )
        .agg(F.sum("copies").alias("copies"))
    )
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("at"))
    firsts = (
        facts.where("copies > 0")
        .groupBy(F.col("conv_id").alias("first_conv"), F.col("content").alias("first_content"))
        .agg(F.min(when).alias("first_turn"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("first_conv")) & (
        F.col("content") == F.col("first_content")
    )
    first = F.coalesce(F.col("first_turn.at").eqNullSafe(F.col("turn")), F.lit(False))
    return facts.join(firsts, same, "left").select(
        "conv_id", "turn", "row_id", "content", "initial", "role_size", "blank", "breaks_off",
        "copies", first.alias("first"),
    )


# --- edits per conversation ---------------------------------------------------------------------

_LINES = {"user": "user:", "assistant": "assistant:"}
SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Conversation:
    """The rows of one conversation, in order, and what becomes of them."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.codes = bytearray()
        #: The row of `ids` that each code stands for.
        self.groups: list[int] = []
        self.ids: list[bytes] = []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.last = None
        self.turns = 0
        self.before = ""

    def add(self, turn, row_id, initial, blank, breaks_off, copies, first) -> None:
        if not copies:
            return
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1
        code = INITIALS.get(initial, 3)
        for copy in range(copies):
            if self.codes and self.before + initial not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = initial
            again = copy > 0 or not first
            must_go, cut = blank or again, breaks_off and not (blank or again)
            self.blank += blank
            self.duplicate += again and not blank
            self.truncated += cut
            self.codes.append(code | (MUST_GO if must_go else 0) | (BREAKS_OFF if cut else 0))
            self.groups.append(len(self.ids))
        self.ids.append(row_id)

    def rows(self) -> Iterator[tuple]:
        """The summary, then the rows that stay, each with what precedes it in the result."""
        cost, audit = repair(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        numbers = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost)
        yield (self.conv_id, -1, None, None, None, *numbers, audit)
        none = (None,) * 7
        at, state, ahead, place = 0, START, [], 0
        for letter in audit:
            if letter == "D":
                at += 1
                continue
            new = "user" if NEXT[state] == USER else "assistant"
            if letter == "I":
                ahead.append(_LINES[new])
                state = NEXT[state]
                continue
            row = self.codes[at]
            state = AFTER[state][row & 3] if letter == "K" else NEXT[state]
            before = "".join(f"{line}\n" for line in ahead)
            role = None if letter == "K" else new
            yield (self.conv_id, place, self.ids[self.groups[at]], before, role, *none)
            ahead, at, place = [], at + 1, place + 1
        if ahead:
            yield (self.conv_id, place, None, "\n".join(ahead), None, *none)


def _edits(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of the conversations of a partition, whose rows come in order."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    current, done = None, []
    names = ("conv_id", "turn", "row_id", "initial", "blank", "breaks_off", "copies", "first")
    for batch in batches:
        for conv, *row in zip(*(batch.column(c).to_pylist() for c in names)):
            if current is None or current.conv_id != conv:
                if current:
                    done.extend(current.rows())
                current = _Conversation(conv)
            current.add(*row)
            if len(done) >= 10_000:
                yield batch_of(done)
                done = []
    if current:
        for row in current.rows():
            done.append(row)
            if len(done) >= 10_000:
                yield batch_of(done)
                done = []
    yield batch_of(done)


def edits(rows: DataFrame) -> DataFrame:
    """Per conversation a summary (`place` -1) and one row per turn that stays or comes last."""
    ship(rows.sparkSession)
    conv = rows.schema["conv_id"].dataType
    fields = T._parse_datatype_string(
        "place bigint, row_id binary, ahead string, new_role string, gaps bigint, "
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
        "audit string"
    )
    schema = T.StructType([T.StructField("conv_id", conv), *fields.fields])
    arrow = to_arrow_schema(schema)
    ordered = flagged(rows).repartition("conv_id").sortWithinPartitions(
        "conv_id", "turn", "initial", "role_size", "content", "row_id"
    )
    return durable(ordered.mapInArrow(lambda batches: _edits(arrow, batches), schema))


# --- the repaired conversations -----------------------------------------------------------------


def repaired_lines(rows: DataFrame, made: DataFrame) -> DataFrame:
    """conv_id, place, line: the repaired conversations, turn by turn (inserted ones included)."""
    texts = (
        identified(rows.where("copies > 0"))
        .groupBy("row_id")
        .agg(F.first("role").alias("role"), F.first("text").alias("text"))
    )
    stay = made.where("place >= 0 and row_id is not null").select(
        "conv_id", "place", "row_id", "ahead", "new_role"
    )
    line = F.concat("ahead", F.coalesce("new_role", "role"), F.lit(":"), "text")
    last = made.where("place >= 0 and row_id is null")
    return (
        stay.join(texts, "row_id")
        .select("conv_id", "place", line.alias("line"))
        .union(last.select("conv_id", "place", F.col("ahead").alias("line")))
    )


def _digests(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per conversation: its summary, which comes first, and the digest of its lines."""
    facts, digest, lines = None, None, 0

    def closed() -> pa.RecordBatch:
        values = [*facts, digest.hexdigest()]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema
        )

    names = schema.names[:-1]
    for batch in slices(batches, "line"):
        columns = [batch.column(c).to_pylist() for c in names]
        done = []
        for i, (place, line) in enumerate(
            zip(batch.column("place").to_pylist(), batch.column("line").to_pylist())
        ):
            if place < 0:
                if facts:
                    done.append(closed())
                facts, digest, lines = [c[i] for c in columns], hashlib.sha256(), 0
            else:
                digest.update(("\n" if lines else "").encode() + line.encode())
                lines += 1
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if facts:
        yield closed()


def repairs(turns: DataFrame) -> DataFrame:
    """One row per conversation of damaged rows (conv_id, turn, role, text, copies)."""
    made = edits(turns)
    conv = made.schema["conv_id"].dataType
    facts = [*SUMMARY, "audit"]
    heads = made.where("place < 0").select(
        "conv_id", "place", F.lit(None).cast("string").alias("line"), *facts
    )
    lines = repaired_lines(turns, made)
    stream = heads.unionByName(lines, allowMissingColumns=True)
    schema = T.StructType(
        [
            T.StructField("conv_id", conv),
            *[made.schema[c] for c in facts],
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    ordered = stream.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(lambda batches: _digests(arrow, batches), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repairs(damaged(turns.select("conv_id", "turn", "role", "text")))
