"""Pages of JSON files, one by one, whatever the size of the files.

A file holds one document or one array of documents. It is never read as a whole: Spark cuts
it at every opening brace, which no text can end with and be valid, so the pieces of a large
file come from many tasks. The pieces of a file are then streamed in order, and a tokenizer
that knows strings, escapes and depth hands out each top-level element as it closes. It holds
one page at a time. Text between, behind or instead of pages comes out as a page of its own
with a fault, so that one bad page is rejected and the others of its file land.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors need not have this library: what tasks run travels with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a page beyond which it is handed out in parts, each with a fault.
LONGEST = 64 << 20

PAGES = "file string, page bigint, value string, fault string"
_MARKS = re.compile(r'\\.|["{}\[\],]|[^\s"{}\[\],\\]+|\\', re.S)
_IN_STRING = re.compile(r'\\.|"|\\$', re.S)


class Splitter:
    """An incremental tokenizer: feed it the text of a file, it yields pages and faults."""

    def __init__(self, longest: int = LONGEST) -> None:
        self.longest = longest
        self.held: list[str] = []
        self.size = 0
        self.depth = 0
        self.base: int | None = None  # depth of the pages: 1 inside an array, else 0
        self.in_string = self.escaped = False
        self.open = self.over = False  # in a page; in one that is too long
        self.comma = False  # whether a page must be behind a comma
        self.pages = 0
        self.closed = False  # the array has ended

    def feed(self, text: str) -> Iterator[tuple[str, str | None]]:
        at = start = 0  # what is before `start` is held or needed no more
        if self.escaped:
            at, self.escaped = 1, False
        while at < len(text):
            if self.in_string:
                mark = _IN_STRING.search(text, at)
                if mark is None:
                    break
                at = mark.end()
                if mark[0] == '"':
                    self.in_string = False
                elif mark[0] == "\\":
                    self.escaped = True
                continue
            mark = _MARKS.search(text, at)
            if mark is None:
                break
            token, at = mark[0], mark.end()
            if not self.open:
                start = mark.start()
                if token == "[" and self.base is None:
                    self.base, self.depth, start = 1, 1, at
                    continue
                if self.base == 1 and not self.closed:
                    if token == "]":
                        self.closed, self.depth, start = True, 0, at
                        continue
                    if token == "," and self.comma:
                        self.comma, start = False, at
                        continue
                self.base = 0 if self.base is None else self.base
                self.open = True
            if token == '"':
                self.in_string = True
            elif token in "{[":
                self.depth += 1
            elif token in "}]":
                ends = self.depth == self.base and not self.closed and self.base == 1
                if ends and token == "]":  # a scalar was the last element
                    yield self._out(text[start : mark.start()])
                    self.closed, self.depth, start = True, 0, at
                    continue
                self.depth = max(self.depth - 1, self._floor)
                if self.depth == self._floor:
                    yield self._out(text[start:at])
                    start = at
            elif token == "," and self.depth == self._floor and self.base == 1 and not self.closed:
                yield self._out(text[start : mark.start()])
                self.comma, start = False, at
            elif token == "\\" and at == len(text):
                self.escaped = True
        if self.open:
            self.held.append(text[start:])
            self.size += len(text) - start
            if self.size > self.longest:
                self.over = True
                yield "".join(self.held), f"document: longer than {self.longest} characters"
                self.held, self.size = [], 0

    @property
    def _floor(self) -> int:
        return 0 if self.closed or not self.base else 1

    def _out(self, last: str) -> tuple[str, str | None]:
        text = "".join([*self.held, last])
        fault = None
        if self.over:
            fault = f"document: longer than {self.longest} characters"
        elif self.closed or (self.base == 0 and self.pages):
            fault = "document: behind the end of another"
        elif not text.strip():
            fault = "document: nothing between two commas"
        elif self.comma:
            fault = "document: not separated from the one before"
        self.held, self.size, self.open, self.over, self.comma = [], 0, False, False, True
        self.pages += 1
        return text, fault

    def end(self) -> Iterator[tuple[str, str | None]]:
        """What is left when the file ends."""
        if self.open:
            unclosed = self.depth > self._floor or self.in_string
            text, fault = self._out("")
            yield text, "document: cut off" if unclosed else fault
        elif self.base == 1 and not self.closed:
            yield "", "document: the file ends inside its array"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of the files of a partition, whose pieces come in order."""
    names = ["file", "page", "value", "fault"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
    rows: list[tuple] = []
    size = 0
    file, splitter = None, None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def numbered(found):
        nonlocal page, size
        for value, fault in found:
            rows.append((file, page, value, fault))
            page, size = page + 1, size + len(value)

    page = 0
    for batch in batches:
        for name, text in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
            if name != file:
                if splitter:
                    numbered(splitter.end())
                file, splitter, page = name, Splitter(), 0
            else:
                text = "{" + text
            numbered(splitter.feed(text))
            if size > 8 << 20 or len(rows) >= 10_000:
                yield batch_of(rows)
                rows, size = [], 0
    if splitter:
        numbered(splitter.end())
    yield batch_of(rows)


def document_pages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """One row per page: its file, its number in it, its text, and what is wrong with its place.

    Order within a file is that of its blocks and of the pieces in them. An empty file has no
    page; one that is cut off has a last page with a fault.
    """
    pieces = (
        spark.read.options(**options)
        .text(path, lineSep="{")
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
        )
    )
    ordered = pieces.repartition("file").sortWithinPartitions("file", "block", "at")
    return ordered.select("file", "value").mapInArrow(_split, PAGES)
