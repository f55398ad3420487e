"""Licence scans: Aho-Corasick over words, and a shunting-yard parser for expressions.

A text becomes its words (ASCII letters lower-cased, digits and everything beyond ASCII are
word characters), one space between them. One automaton finds all notice phrases and the
identifier tags in all texts of a slice together. Behind a tag with its colon the rest of the
line is read as a licence expression: the shunting-yard algorithm turns `and`, `or`, `with` and
brackets into postfix order (`with` binds closest, then `and`, then `or`), which is then
evaluated. `SPDX-License-Identifier:` and `License-Expression:` say that an expression follows;
`License:` and `Licence:` count where they begin a line, and may also introduce prose.

Labels: the base phrases give theirs wherever their words stand consecutively. Further
phrases and the identifiers of expressions give labels of the same kind. Behind a tag that
says so, an identifier that is not known is one too, if the expression fills its line or the
identifier has a digit or hyphen; behind the others only beside a known one, in an expression
that fills its line.

Score: how much the found licences ask of a user, from 0 (nothing found, or a public domain
dedication) to 1 (all rights reserved): the strictest finding counts. In an expression `or`
takes the milder side, `and` the stricter, and an exception after `with` halves what the
licence asks. An identifier that is not known asks `UNKNOWN`.

Null texts are empty texts, without words. Phrases may overlap; each place counts. A
malformed expression is read as far as it parses; the rest of its line is prose.
A null id keeps its row. Repeated rows get equal results. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import LOWER, append, text_buffer, words_of

#: Base phrases and their labels (fixed values).
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Further notice phrases, as words, and their labels.
NOTICES = {
    "apache license version 2 0": "apache-2.0",
    "permission is hereby granted free of charge": "mit",
    "mit license": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "cc0": "cc0",
    "public domain": "public-domain",
}

#: Words of identifier tags, and whether an expression surely follows. Of `license expression`
#: and `license` in one place, or of two tags with one colon, each is read; labels are sets.
TAGS = {
    "spdx license identifier": True,
    "license expression": True,
    "license": False,
    "licence": False,
}
#: What may stand before a tag in its line: comment signs, quotes, brackets and blanks.
_LEAD = frozenset(" \t\r#/*;<>!\"'%.[{(-")
_COLON = re.compile(r"[A-Za-z]+[\"'\] \t]*:")

#: What a licence asks of a user, by the start of its identifier (longest start counts).
DEMANDS = {
    "0bsd": 0.0,
    "agpl": 0.8,
    "apache": 0.2,
    "bsd": 0.1,
    "cc-by": 0.3,
    "cc-by-nc": 0.7,
    "cc-by-nd": 0.7,
    "cc-by-sa": 0.5,
    "cc0": 0.0,
    "epl": 0.4,
    "gpl": 0.6,
    "isc": 0.1,
    "lgpl": 0.5,
    "mit": 0.1,
    "mpl": 0.4,
    "public-domain": 0.0,
    "reserved": 1.0,
    "unlicense": 0.0,
    "zlib": 0.1,
}
UNKNOWN = 0.5

_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_BINDS = {"or": 1, "and": 2, "with": 3}


def _not_word() -> np.ndarray:
    table = np.ones(256, bool)
    table[ord("0") : ord("9") + 1] = False
    table[ord("a") : ord("z") + 1] = False
    table[128:] = False
    return table


NOT_WORD = _not_word()


def demand(label: str) -> float | None:
    """What the licence asks; None for an identifier that is not known."""
    starts = [s for s in DEMANDS if label == s or label.startswith((f"{s}-", f"{s}+"))]
    return DEMANDS[max(starts, key=len)] if starts else None


def _parsed(line: str, start: int, stop: int) -> tuple[list[str], int]:
    """The tokens of an expression in postfix order, and where it ends."""
    out: list[str] = []
    held: list[str] = []
    operand = True  # one is due
    end = start
    for found in _TOKEN.finditer(line, start, stop):
        word = found[0].lower()
        if operand and word == "(":
            held.append(word)
        elif operand and word not in _BINDS and word != ")":
            out.append(word.rstrip(".:"))
            operand = False
        elif not operand and word in _BINDS:
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[word]:
                out.append(held.pop())
            held.append(word)
            operand = True
        elif not operand and word == ")" and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        else:
            break
        end = found.end()
    if operand and held and held[-1] != "(":
        held.pop()  # an operator without its right side
    return out + [x for x in reversed(held) if x != "("], end


def postfix(expression: str) -> list[str]:
    """The expression's tokens in postfix order, as far as it is well formed.

    Stops at the first token that cannot follow: an expression ends where prose begins.
    """
    return _parsed(expression, 0, len(expression))[0]


def evaluate(
    line: str, tagged: bool = False, start: int = 0, stop: int | None = None
) -> tuple[set[str], float] | None:
    """(identifiers, demand) of the licence expression at `start`; None if it holds none.

    If it is not `tagged`, it may be prose and must hold a known identifier.
    """
    stop = len(line) if stop is None else stop
    tokens, end = _parsed(line, start, stop)
    alone = not _TOKEN.search(line, end, stop)
    known = False
    stack: list[tuple[set[str], float]] = []
    for token in tokens:
        if token not in _BINDS:
            asks = demand(token)
            known |= asks is not None
            named = asks is not None or alone or (tagged and bool(re.search(r"[-0-9]", token)))
            stack.append(({token} if named else set(), UNKNOWN if asks is None else asks))
        elif len(stack) > 1:
            (right, asks_right), (left, asks) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, asks / 2))
            else:
                pick = min if token == "or" else max
                stack.append((left | right, pick(asks, asks_right)))
    return stack[-1] if stack and stack[-1][0] and (known or tagged) else None


def behind_tag(texts: str, first: int, last: int, begin: int, stop: int, sure: bool) -> int | None:
    """Where a tag's expression begins: behind its colon; None if no colon follows at once.

    `first` and `last` are where the first and last word of the tag begin, in a text from
    `begin` to `stop`. A tag that is not `sure` must have no words before it in its line.
    """
    colon = _COLON.match(texts, last, stop)
    if colon is None:
        return None
    while not sure and first > begin and texts[first - 1] != "\n":
        if texts[first - 1] not in _LEAD:
            return None
        first -= 1
    return colon.end()


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases: dict[str, tuple] = {}
    for phrase, label in NOTICES.items():
        phrases[phrase] = (label, False)
    for phrase, label in BASE.items():
        phrases[phrase] = (label, True)
    for tag, sure in TAGS.items():
        phrases[tag] = (None, sure)
    for phrase, (label, base) in phrases.items():
        found.add_word(f" {phrase} ", (len(phrase) + 1, label, base))
    found.make_automaton()
    return found


def scan(texts: pa.Array) -> list[pa.Array]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of each text."""
    data, offsets = text_buffer(texts)
    compact, start, _, begin, first = words_of(LOWER[data], offsets, NOT_WORD)
    n = len(offsets) - 1
    n_base = [0] * n
    spans: list[list[int] | None] = [None] * n
    base_labels: list[set[str]] = [set() for _ in range(n)]
    labels: list[set[str]] = [set() for _ in range(n)]
    score = [0.0] * n
    # One character per byte, so that positions are bytes; a phrase may not cross texts.
    stream = " " + compact.tobytes().decode("latin-1")
    plain, line_end = data.tobytes().decode("latin-1"), -1
    for at, (size, label, base) in automaton().iter(stream):
        # `stream` is one longer than `compact`: the phrase's first word starts here.
        word = int(np.searchsorted(start, at - size))
        doc = int(np.searchsorted(first, word, "right")) - 1
        last = int(np.searchsorted(start, at - 1, "right")) - 1
        if last >= first[doc + 1]:
            continue
        if label is None:
            stop = int(offsets[doc + 1]) - 1
            place = behind_tag(
                plain, int(begin[word]), int(begin[last]), int(offsets[doc]), stop, base
            )
            if place is None:
                continue
            if not place <= line_end <= stop:
                line_end = plain.find("\n", place, stop)
                line_end = stop if line_end < 0 else line_end
            if found := evaluate(plain, base, place, line_end):
                labels[doc] |= found[0]
                score[doc] = max(score[doc], found[1])
            continue
        labels[doc].add(label)
        score[doc] = max(score[doc], demand(label))
        if base:
            base_labels[doc].add(label)
            n_base[doc] += 1
            own = word - int(first[doc])
            seen = spans[doc]
            spans[doc] = [own, own] if seen is None else [min(seen[0], own), max(seen[1], own)]
    joined = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
    return [
        pa.array(np.diff(first).astype(np.int64)),
        pa.array(n_base, pa.int64()),
        pa.array([s and s[0] for s in spans], pa.int64()),
        pa.array([s and s[1] for s in spans], pa.int64()),
        joined(base_labels),
        joined(labels),
        pa.array(score, pa.float64()),
    ]


FIELDS = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double"
)


def scanned(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id and FIELDS."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return append(narrow, scan, FIELDS, keep=["doc_id"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
