"""Benchmark decontamination: q-gram lemma filtering and banded alignment.

Texts and benchmark items are read as words (letters, digits and everything beyond ASCII,
lower-cased) with one space between, as characters. An item of m characters is in a
document if some stretch of it is at most k = `EDIT_RATE` * m edits away. Of an item of more
than `STRETCH_CHARS` characters, a document may also hold a part: any `STRETCH_CHARS`
characters in a row of the item, wherever they begin, within the budget of so many.

Such a stretch shares at least T = m - Q + 1 - k * Q character q-grams with the item, and
they lie on diagonals (place in the document minus place in the item) at most k from its
own. The q-grams of a slice of documents are looked up together, and counted by document,
item and diagonal band. Bands overlap so that every run of 2k + 1 diagonals lies in one;
bands with T or more shared q-grams are retained and verified by an alignment that is
confined to the band. The filter is the lemma itself, so nothing within the budget is lost.
The stretches of an item that is not there as a whole go the same way: the bound is asked of
the q-grams of each stretch, and each that meets it is aligned.

A hit has the spans that were matched, in characters as they are read here: the whole item if
it is there, else its stretch with the fewest edits (of several, the first). The query and `keep_clean` search
for stretches; `hits` does if it is asked to.

The benchmark goes to the tasks in blocks of about `BLOCK_CHARS` characters, a pass over the
documents for each; a benchmark of usual size is one block.

Items with fewer than `LEAST_CHARS` characters after this reading are found without edits
(`Short`): as the whole text; from `SHORT_WORDS` words on also as whole sentences or lines,
that is between two breaks (`BREAKS`) or ends of the text; and anywhere if they have
`SHORT_WIDE` letters of a script that sets no spaces. So a bare "yes" flags only a text that
says nothing else. An item without a letter or digit matches nothing. Null texts are empty texts. Documents without a hit are not in the result of
`hits`. Repeated rows and equal items give a hit each. A null id keeps its hits. Empty
tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import append, text_buffer, unused, words_of

Q = 12
EDIT_RATE = 0.05
LEAST_CHARS = 24
#: Of a longer item, every stretch of so many characters is searched for as well.
STRETCH_CHARS = 60
#: Characters of benchmark items that go to the tasks at once.
BLOCK_CHARS = 4_000_000
FILTER_BITS = 22
#: Words, or letters of scripts without spaces, of shorter items that are searched for in texts.
SHORT_WORDS = 3
SHORT_WIDE = 8
#: First and last code points of those scripts: Thai and Lao, Myanmar, Khmer, kana and Han.
WIDE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0x20000, 0x3FFFF))
#: Meetings of q-grams that are counted together.
PAIRS = 1 << 20
#: Cells of the alignment tables that are filled together.
CELLS = 2_000_000
#: An edit, and no path, as the alignment's costs have them.
EDIT, FAR = 1 << 32, 1 << 52


def _not_word() -> np.ndarray:
    table = np.ones(256, bool)
    table[ord("0") : ord("9") + 1] = False
    table[ord("A") : ord("Z") + 1] = False
    table[ord("a") : ord("z") + 1] = False
    table[128:] = False
    return table


NOT_WORD = _not_word()

#: What ends a sentence, a line, a cell or a quotation.
BREAKS = np.zeros(256, bool)
BREAKS[list(b'\n\r\t\v\f.!?;:"()[]{}<>|')] = True


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts as code points, a space after each, and the n + 1 offsets."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    data, offsets = text_buffer(lower)
    compact, start, _, _, first = words_of(data, offsets, NOT_WORD)
    starts = np.concatenate(([0], np.cumsum((compact & 0xC0) != 0x80)))
    ends = np.concatenate((start, [len(compact)]))
    points = np.frombuffer(compact.tobytes().decode().encode("utf-32-le"), np.uint32)
    return points, starts[ends[first]]


def grams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q characters at every place; the last q - 1 places have none."""
    with np.errstate(over="ignore"):
        h = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        # Spans double while they fit; the rest comes from an overlapping span.
        span = 1
        while 2 * span <= q:
            factor = np.uint64(pow(0xD6E8FEB86659FD93, span, 1 << 64))
            h = h[: max(len(h) - span, 0)] * factor + h[span:]
            span *= 2
        if span < q:
            rest = q - span
            factor = np.uint64(pow(0xD6E8FEB86659FD93, rest, 1 << 64))
            h = h[: max(len(h) - rest, 0)] * factor + h[rest:]
        return (h ^ (h >> np.uint64(33))) * np.uint64(0xBF58476D1CE4E5B9)


def is_wide(point: int) -> bool:
    return any(low <= point <= high for low, high in WIDE)


class Short:
    """Items that are too short for the lemma, found by equality."""

    def __init__(self, ids: list[int | None], texts: list[np.ndarray]) -> None:
        self.ids, self.size = ids, [len(t) for t in texts]
        self.whole: dict[bytes, list[int]] = {}
        #: By size and characters the items that are searched for inside texts.
        self.inner: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
        for i, own in enumerate(texts):
            self.whole.setdefault(own.tobytes(), []).append(i)
            words = int((own == 0x20).sum()) + 1
            if sum(is_wide(x) for x in own.tolist()) >= SHORT_WIDE:
                # Punctuation beyond ASCII is read as part of a word.
                text = own.tobytes().decode("utf-32-le")
                on = [x for x, c in enumerate(text) if c.isalnum()]
                own, words = own[on[0] : on[-1] + 1], 0
            elif words < SHORT_WORDS:
                continue
            self.inner.setdefault(len(own), {}).setdefault(own.tobytes(), []).append((i, words))

    def hits(
        self, texts: pa.Array, points: np.ndarray, offsets: np.ndarray
    ) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, start and end in `points`) of what is there."""
        if not self.ids:
            return
        for d in np.flatnonzero(np.diff(offsets) <= LEAST_CHARS).tolist():
            begin, end = int(offsets[d]), int(offsets[d + 1]) - 1
            for i in self.whole.get(points[begin : max(begin, end)].tobytes(), []):
                yield d, i, begin, end
        sealed = None
        for size, items in self.inner.items():
            if len(points) < size:
                continue
            own = np.concatenate([grams(np.frombuffer(x, np.uint32), size) for x in items])
            for at in np.flatnonzero(np.isin(grams(points, size), own)).tolist():
                d = int(np.searchsorted(offsets, at, "right")) - 1
                if at + size >= offsets[d + 1]:
                    continue
                for i, words in items.get(points[at : at + size].tobytes(), []):
                    if words:
                        sealed = sealed or Sealed(texts, points)
                        if not sealed.between(at, at + size, words):
                            continue
                    yield d, i, at, at + size


class Sealed:
    """Where sentences and lines begin and end in the characters of texts."""

    def __init__(self, texts: pa.Array, points: np.ndarray) -> None:
        lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        data, offsets = text_buffer(lower)
        _, start, end, begin, first = words_of(data, offsets, NOT_WORD)
        self.points = points
        self.word = np.concatenate(([0], np.cumsum(points == 0x20)))
        breaks = np.concatenate(([0], np.cumsum(BREAKS[data])))
        #: Whether a break, or the end of a text, comes before each word and behind the last.
        after = begin + end - start
        self.before = np.ones(len(begin) + 1, bool)
        self.before[1:-1] = breaks[begin[1:]] > breaks[after[:-1]]
        self.before[first] = True

    def between(self, begin: int, end: int, words: int) -> bool:
        """Whether points[begin:end] are `words` whole words between two breaks."""
        if (begin and self.points[begin - 1] != 0x20) or self.points[end] != 0x20:
            return False
        word = self.word[begin]
        return bool(self.before[word] and self.before[word + words])


def budget_of(size):
    """Edits that `size` characters may have.

    Small enough for the lemma to ask for at least one shared q-gram.
    """
    return np.minimum((EDIT_RATE * np.asarray(size)).astype(np.int64), (size - Q) // Q)


class Index:
    """The q-grams of a block of items."""

    def __init__(self, items: tuple[tuple[int | None, str], ...]) -> None:
        points, offsets = characters(pa.array([t for _, t in items], pa.string()))
        # Without the space that closes an item.
        sizes = np.maximum(np.diff(offsets) - 1, 0)
        on = np.flatnonzero(sizes >= LEAST_CHARS)
        self.ids = [items[i][0] for i in on]
        few = np.flatnonzero((sizes > 0) & (sizes < LEAST_CHARS))
        self.short = Short(
            [items[i][0] for i in few], [points[offsets[i] : offsets[i] + sizes[i]] for i in few]
        )
        self.points, self.begin = points, offsets[on]
        self.texts = [points[offsets[i] : offsets[i] + sizes[i]] for i in on]
        self.size = sizes[on]
        self.budget = budget_of(self.size)
        self.least = self.size - Q + 1 - self.budget * Q
        each = [grams(t) for t in self.texts]
        hashes = np.concatenate(each) if each else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(each)), [len(h) for h in each]) if each else hashes
        place = np.concatenate([np.arange(len(h)) for h in each]) if each else hashes
        order = np.argsort(hashes, kind="stable")
        self.item, self.place = item[order].astype(np.int64), place[order].astype(np.int64)
        self.hashes, self.first, self.count = np.unique(
            hashes[order], return_index=True, return_counts=True
        )
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def shared(
        self, points: np.ndarray, offsets: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, place, number of the q-gram) of every q-gram that items have, too."""
        if not len(self.size) or len(points) < Q:
            none = np.zeros(0, np.int64)
            return none, none, none
        hashes = grams(points)
        at = np.flatnonzero(self.filter[self._slot(hashes)])
        slot = np.searchsorted(self.hashes, hashes[at])
        slot[slot == len(self.hashes)] = 0
        doc = np.searchsorted(offsets, at, "right") - 1
        on = (self.hashes[slot] == hashes[at]) & (at + Q <= offsets[doc + 1])
        return doc[on], at[on], slot[on]

    def meetings(self, doc: np.ndarray, at: np.ndarray, slot: np.ndarray) -> Iterator[tuple]:
        """(document, item, place in the item, diagonal) of shared q-grams, in rounds.

        A q-gram that is many times in a text and in an item meets as often as the product of
        both, so the places of the text are taken a part at a time. What may share a band with
        a place to come is in the next round, too: every band is whole in one of them.
        """
        count = self.count[slot]
        ends = np.cumsum(count)
        most = max(int(self.budget.max(initial=0)), int(budget_of(STRETCH_CHARS)))
        reach = int(self.size.max(initial=0)) + 2 * (2 * most + 1)
        held = [np.zeros(0, np.int64)] * 4
        start = 0
        while start < len(at):
            before = int(ends[start - 1]) if start else 0
            stop = max(int(np.searchsorted(ends, before + PAIRS, "right")), start + 1)
            own = count[start:stop]
            first = np.repeat(self.first[slot[start:stop]] - np.cumsum(own) + own, own)
            entry = first + np.arange(len(first))
            place = self.place[entry]
            new = (
                np.repeat(doc[start:stop], own), self.item[entry], place,
                np.repeat(at[start:stop], own) - place,
            )
            pairs = [np.concatenate(both) for both in zip(held, new)]
            yield tuple(pairs)
            start = stop
            if start < len(at):
                near = pairs[3] >= at[start] - reach
                held = [x[near] for x in pairs]

    def banded(self, doc, item, diagonal, budget, most: int) -> tuple[np.ndarray, tuple[int, int]]:
        """Keys of the two bands of each q-gram, those of all first bands before the others.

        `most` is more than any diagonal; the numbers returned with the keys are for `opened`.
        """
        lead = int(self.size.max()) + 2 * int(self.budget.max()) + 2
        band = (diagonal + lead) // (2 * budget + 1) + 1
        most += 2 * lead + 3
        pair = doc * len(self.size) + item
        return np.concatenate((pair * most + band, pair * most + band - 1)), (lead, most)

    def opened(self, key, numbers: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, item and number of the band of each key."""
        pair, band = np.divmod(key, numbers[1])
        return *np.divmod(pair, len(self.size)), band

    def retained(self, doc, item, diagonal, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, item, lowest diagonal) of bands that meet the lemma's bound."""
        if not len(doc):
            return doc, item, diagonal
        key, numbers = self.banded(doc, item, diagonal, self.budget[item], most)
        found, count = np.unique(key, return_counts=True)
        doc, item, band = self.opened(found, numbers)
        on = count >= self.least[item]
        doc, item, band = doc[on], item[on], band[on]
        return doc, item, (band - 1) * (2 * self.budget[item] + 1) - numbers[0]

    def stretches(self, doc, item, place, diagonal, most: int) -> tuple[np.ndarray, ...]:
        """(document, item, start in the item, lowest diagonal) of what meets the bound.

        Every stretch of STRETCH_CHARS characters of an item is counted for itself.
        """
        none = np.zeros(0, np.int64)
        budget = int(budget_of(STRETCH_CHARS))
        least, span = STRETCH_CHARS - Q + 1 - budget * Q, STRETCH_CHARS - Q + 1
        on = self.size[item] > STRETCH_CHARS
        if not on.any():
            return none, none, none, none
        doc, item, place, diagonal = doc[on], item[on], place[on], diagonal[on]
        key, numbers = self.banded(doc, item, diagonal, budget, most)
        found, group, count = np.unique(key, return_inverse=True, return_counts=True)
        # The q-grams of bands that have enough of them at all, by band and place.
        on = np.flatnonzero(count[group] >= least)
        group, place = group[on], np.concatenate((place, place))[on]
        order = np.lexsort((place, group))
        group, place = group[order], place[order]
        out = [(none, none, none, none)]
        ends = np.flatnonzero(np.diff(np.concatenate((group, [-1]))))
        for first, last in zip([0, *(ends[:-1] + 1)], ends + 1):
            own = place[first:last]
            d, i, band = (int(x) for x in self.opened(found[group[first]], numbers))
            starts = np.arange(
                max(0, own[0] - span + 1), min(self.size[i] - STRETCH_CHARS, own[-1]) + 1
            )
            within = np.searchsorted(own, starts + span) - np.searchsorted(own, starts)
            starts = starts[within >= least]
            low = (band - 1) * (2 * budget + 1) - numbers[0]
            out.append((*(np.full(len(starts), x) for x in (d, i)), starts, starts * 0 + low))
        return tuple(np.concatenate(x) for x in zip(*out))

    def aligned(
        self,
        points: np.ndarray,
        offsets: np.ndarray,
        doc: np.ndarray,
        begin: np.ndarray,
        size: np.ndarray,
        low: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fewest edits between characters of an item and a stretch of the document in a band.

        The characters are the `size` ones from `begin` of the block. The band has the
        diagonals from `low` to low + 4k + 1. Also returned are the start and end of that
        stretch in `points`. Bands are aligned together, one row of the tables at a time; the
        diagonal on which a path starts is carried in the low bits of its cost.
        """
        edits, start, end = (np.zeros(len(doc), np.int64) for _ in range(3))
        budget = budget_of(size)
        order = np.argsort(size, kind="stable")
        done = 0
        while done < len(order):
            span = max(1, CELLS // (4 * int(budget[order[done:]].max()) + 2))
            part = order[done : done + min(span, 4_096)]
            done += len(part)
            rows, width = size[part], 4 * budget[part] + 2
            across = np.arange(int(width.max()))
            apart = across * EDIT
            own = begin[part, None] + np.arange(int(rows.max()))
            own = self.points[np.minimum(own, len(self.points) - 1)]
            cost = np.where(across < width[:, None], across, FAR)
            first, last = offsets[doc[part]], offsets[doc[part] + 1] - 1
            for i in range(own.shape[1]):
                at = low[part, None] + i + across
                there = points[np.clip(at, 0, len(points) - 1)]
                given = (at >= first[:, None]) & (at < last[:, None])
                step = cost + ((there != own[:, i, None]) | ~given) * EDIT
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + EDIT)
                step = np.where(across < width[:, None], step, FAR)
                cost = np.minimum.accumulate(step - apart, axis=1) + apart
                cost = np.where(across < width[:, None], cost, FAR)
                ready = np.flatnonzero(rows == i + 1)
                if len(ready):
                    column = cost[ready].argmin(axis=1)
                    best = cost[ready, column]
                    edits[part[ready]] = best // EDIT
                    start[part[ready]] = low[part[ready]] + best % EDIT
                    end[part[ready]] = low[part[ready]] + i + 1 + column
        start = np.clip(start, offsets[doc], offsets[doc + 1] - 1)
        return edits, start, np.clip(end, start, offsets[doc + 1] - 1)

    def hits(self, texts: pa.Array, parts: bool) -> Iterator[list[tuple]]:
        """For each text its hits, as the values of HIT; with `parts` also those of stretches."""
        points, offsets = characters(texts)
        found: list[dict[int, tuple]] = [{} for _ in range(len(texts))]

        def settle(doc, item, place, size, low) -> None:
            got = self.aligned(points, offsets, doc, self.begin[item] + place, size, low)
            on = got[0] <= budget_of(size)
            columns = (doc, item, got[0], place, place + size, got[1] - offsets[doc], got[2] - offsets[doc])
            for d, i, *hit in zip(*(c[on].tolist() for c in columns)):
                found[d][i] = min(tuple(hit), found[d].get(i, tuple(hit)))

        shared = self.shared(points, offsets)
        for doc, item, _, diagonal in self.meetings(*shared):
            d, i, low = self.retained(doc, item, diagonal, len(points))
            settle(d, i, i * 0, self.size[i], low)
        if parts:
            # Items that are there as a whole need no search for their stretches.
            known = [d * len(self.size) + i for d, of_text in enumerate(found) for i in of_text]
            whole = np.array(known, np.int64)
            for doc, item, place, diagonal in self.meetings(*shared):
                rest = ~np.isin(doc * len(self.size) + item, whole)
                d, i, place, low = self.stretches(
                    doc[rest], item[rest], place[rest], diagonal[rest], len(points)
                )
                settle(d, i, place, np.full(len(d), STRETCH_CHARS), low + place)
        short: list[dict[int, tuple]] = [{} for _ in range(len(texts))]
        for d, i, begin, end in self.short.hits(texts, points, offsets):
            span = (0, 0, end - begin, begin - int(offsets[d]), end - int(offsets[d]))
            short[d][i] = min(span, short[d].get(i, span))
        for of_text, of_short in zip(found, short):
            out = [(self.ids[i], h[0], int(self.size[i]), *h[1:]) for i, h in sorted(of_text.items())]
            yield out + [(self.short.ids[i], h[0], self.short.size[i], *h[1:]) for i, h in sorted(of_short.items())]


@lru_cache(maxsize=4)
def index(items: tuple[tuple[int | None, str], ...]) -> Index:
    return Index(items)


HIT = (
    "array<struct<item_id: bigint, edits: int, item_chars: int, "
    "item_from: int, item_to: int, text_from: int, text_to: int>>"
)
_HIT = pa.list_(
    pa.struct(
        [
            ("item_id", pa.int64()),
            ("edits", pa.int32()),
            ("item_chars", pa.int32()),
            ("item_from", pa.int32()),
            ("item_to", pa.int32()),
            ("text_from", pa.int32()),
            ("text_to", pa.int32()),
        ]
    )
)


def blocks(benchmark: DataFrame) -> Iterator[tuple[tuple[int | None, str], ...]]:
    """The items, about BLOCK_CHARS characters at a time, in a fixed order."""
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-chars // BLOCK_CHARS)
    for number in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        yield tuple((r[0], r[1]) for r in own.orderBy("item_id", "text").collect())


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    name: str = "hits",
    keep: list[str] | None = None,
    parts: bool = True,
) -> DataFrame:
    """`keep` (all columns if not given) and the benchmark items found in each text.

    With `parts` also the items of which only stretches are there.
    """
    kept = docs.columns if keep is None else keep
    (source,) = unused(docs.columns, "__read")
    chosen = [F.col(f"`{c}`") for c in kept]
    read = docs.select(*chosen, F.col(f"`{text}`").alias(source))
    columns = []
    for number, items in enumerate(blocks(benchmark)):

        def compute(texts: pa.Array, items=items) -> list[pa.Array]:
            return [pa.array(list(index(items).hits(texts, parts)), _HIT)]

        (own,) = unused(read.columns, f"__hits{number}")
        read = append(read, compute, f"`{own}` {HIT}", source)
        columns.append(F.col(own))
    found = F.concat(*columns) if columns else F.array().cast(HIT)
    return read.select(*chosen, found.alias(name))


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    parts: bool = False,
) -> DataFrame:
    """One row per document and item that is in it; with `parts` also if a stretch of it is.

    doc_id, item_id, edits, item_chars, and the matched spans of the item (item_from,
    item_to) and of the text (text_from, text_to).
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = with_hits(narrow, benchmark, keep=["doc_id"], parts=parts)
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a benchmark item or a stretch of one, with all their columns."""
    (name,) = unused(docs.columns, "__leaks")
    return with_hits(docs, benchmark, text, name).where(F.size(name) == 0).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
        parts=True,
    )
