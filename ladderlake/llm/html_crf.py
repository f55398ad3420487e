"""HTML extraction: a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: the text between block-level tags, with the elements that
are open around it. Each block has features of its ancestors (tags, words of class, id and
role) and of its text (length, links, punctuation, position). The field scores every block
as main text or not, and neighbouring labels together; Viterbi finds the best labelling of
the page as a whole. Its weights are trained on labelled pages (`page_samples`) by gradient
ascent on the conditional likelihood, with forward-backward over all pages at once.

The text of a page is that of its main blocks in page order, character references decoded,
white space inside a block made one space, trimmed, joined by an empty line.

A null page is an empty page; a page without main text gives an empty text. Unclosed or
stray tags are read as browsers mostly do; nothing is cut off, however long. A null page_id
or url is kept. Repeated rows get equal results. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderlake.llm.common import append
from ladderlake.llm.page_samples import labelled_pages

#: Labelled pages the field is trained on, and steps of the ascent.
TRAINING_PAGES = 600
STEPS = 120

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
OPAQUE = frozenset(
    "script style noscript template iframe object svg canvas audio video textarea select "
    "datalist button title".split()
)
#: Of these, those that another one of their kind, opened before they end, shows to be unclosed.
FLAT = frozenset("select datalist button".split())
#: An opening tag closes these open elements, up to the nearest of the second kind.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
#: Opening one of these ends an open paragraph.
ENDS_PARAGRAPH = BLOCKS - {"body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>",
    re.S,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_WORD = re.compile(r"[a-z]+")
_ENDING = re.compile(r"</(?:" + "|".join(sorted(OPAQUE)) + r")\s*>", re.I)


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


@lru_cache(maxsize=16_384)
def _element(tag: str, attributes: str) -> str:
    """A tag and the words of its class, id and role, as one string."""
    found = " ".join(_NAMED.findall(attributes)).lower() if attributes else ""
    return " ".join([tag, *sorted(set(_WORD.findall(found)))])


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, those without text left out."""
    out: list[Block] = []
    names: list[str] = []
    signs: list[str] = []
    runs: list[str] = []
    linked = links = at = 0
    unclosed: set[str] = set()  # tags that nothing closes from here on

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(runs).split())
        if text:
            out.append(Block(text, tuple(signs), min(linked, len(text))))
        runs.clear()
        linked = 0

    def take(run: str) -> None:
        nonlocal linked
        if run:
            text = html.unescape(run) if "&" in run else run
            runs.append(text)
            if links:
                linked += len(text.strip())

    def shut(depth: int) -> None:
        del names[depth:], signs[depth:]

    while found := _TAG.search(page, at):
        take(page[at : found.start()])
        at = found.end()
        slash, tag, attributes = found[1], found[2], found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if tag == "a":
                links = max(links - 1, 0)
            elif tag in BLOCKS:
                flush()
                if tag in names:
                    shut(len(names) - 1 - names[::-1].index(tag))
            continue
        if tag in OPAQUE:
            if not attributes.endswith("/"):
                at = _behind(page, at, tag, unclosed)
            runs.append(" ")
        elif tag == "a":
            links = 1
        elif tag in ("br", "wbr", "img", "input"):
            runs.append(" ")
        elif tag in BLOCKS:
            flush()
            links = 0
            if tag in ENDS_PARAGRAPH and "p" in names:
                shut(len(names) - 1 - names[::-1].index("p"))
            if tag in CLOSES:
                ended, until = CLOSES[tag]
                for depth in range(len(names) - 1, -1, -1):
                    if names[depth] in until:
                        break
                    if names[depth] in ended:
                        shut(depth)
            if tag not in VOID:
                names.append(tag)
                signs.append(_element(tag, attributes))
    take(page[at:])
    flush()
    return out


def _behind(page: str, at: int, tag: str, unclosed: set[str]) -> int:
    """Where an opaque element ends that was opened before `at`.

    That is behind its end tag. One that has none ends before the next tag of a block, so that
    it takes nothing with it but what stands beside it.
    """
    closing = None
    if tag not in unclosed:
        closing = (_either if tag in FLAT else _closing)(tag).search(page, at)
        if closing is None:
            unclosed.add(tag)
    if closing and closing[0][1] == "/":
        return closing.end()
    block = _BLOCK_TAG.search(page, at)
    return block.start() if block else len(page)


@lru_cache(maxsize=64)
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*>", re.I)


@lru_cache(maxsize=64)
def _either(tag: str) -> re.Pattern:
    return re.compile(rf"</?{tag}\b[^>]*>", re.I)


_BLOCK_TAG = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS))})\b[^>]*>", re.I)


# --- features ---------------------------------------------------------------------------------


@lru_cache(maxsize=16_384)
def _path_features(path: tuple[str, ...]) -> tuple[str, ...]:
    found = set()
    for sign in path:
        tag, *words = sign.split(" ")
        if tag not in ("html", "body"):
            found.add(f"in:{tag}")
            found.update(f"named:{w}" for w in words)
    parent = path[-1].split(" ")[0] if path else "none"
    found.add(f"tag:{parent}")
    if len(path) > 1:
        found.add(f"above:{path[-2].split(' ')[0]}")
    return tuple(sorted(found))


def _text_features(block: Block, number: int, count: int) -> list[str]:
    text = block.text
    size = len(text)
    share = block.linked / size
    out = [
        "bias",
        f"size:{min(size.bit_length(), 11)}",
        "links:" + ("none" if not share else "few" if share < 0.3 else "some" if share < 0.7 else "all"),
        f"ends:{text[-1] in '.!?:;”\"'}",
        f"commas:{min(text.count(','), 3)}",
    ]
    if "©" in text:
        out.append("copyright")
    if number == 0:
        out.append("first")
    if number == count - 1:
        out.append("last")
    return out


def features(page: list[Block]) -> list[list[str]]:
    n = len(page)
    return [[*_path_features(b.path), *_text_features(b, i, n)] for i, b in enumerate(page)]


# --- the field --------------------------------------------------------------------------------


@dataclass
class Field:
    """Weights of features (for main text), of pairs of labels, and of the first label."""

    weight: dict[str, float]
    pair: np.ndarray
    start: np.ndarray

    def labels(self, rows: list[list[str]]) -> list[int]:
        """Viterbi: the best labelling of a page's blocks."""
        if not rows:
            return []
        weight = self.weight
        (p00, p01), (p10, p11) = self.pair.tolist()
        back = []
        off, on = self.start.tolist()
        for i, row in enumerate(rows):
            given = sum(weight.get(f, 0.0) for f in row)
            if i:
                from_off, from_on = off, on
                back.append((int(from_on + p10 > from_off + p00), int(from_on + p11 > from_off + p01)))
                off = max(from_off + p00, from_on + p10)
                on = max(from_off + p01, from_on + p11)
            on += given
        label = int(on > off)
        out = [label]
        for came in reversed(back):
            label = came[label]
            out.append(label)
        return out[::-1]


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = STEPS) -> Field:
    """Maximise the conditional likelihood of the labels, with a little weight decay."""
    pages = [p for p in pages if p[0]]
    counts: dict[str, int] = {}
    for rows, _ in pages:
        for row in rows:
            for f in row:
                counts[f] = counts.get(f, 0) + 1
    names = sorted(f for f, c in counts.items() if c >= 5)
    number = {f: i for i, f in enumerate(names)}
    n, longest = len(pages), max(len(rows) for rows, _ in pages)
    label = np.zeros((n, longest), np.int64)
    real = np.zeros((n, longest), bool)
    held: list[list[int]] = []
    for p, (rows, given) in enumerate(pages):
        label[p, : len(rows)] = given
        real[p, : len(rows)] = True
        held += [[number[f] for f in row if f in number] for row in rows]
    # The features of all blocks in a row, and where each block's begin ("bias" is in all).
    used = np.concatenate([np.array(x) for x in held])
    sizes = np.array([len(x) for x in held])
    begins = np.cumsum(sizes) - sizes
    values = [np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)]
    state = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    both = real[:, 1:]
    seen_pair = np.zeros((2, 2))
    np.add.at(seen_pair, (label[:, :-1][both], label[:, 1:][both]), 1)
    seen_start = np.bincount(label[:, 0], minlength=2)
    for step in range(1, steps + 1):
        weight, pair, start = values
        given = np.zeros((n, longest))
        given[real] = np.add.reduceat(weight[used], begins)
        score = np.stack([np.zeros_like(given), given], axis=2)
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            moved = _log_sum(ahead[:, t - 1, :, None] + pair, 1) + score[:, t]
            ahead[:, t] = np.where(real[:, t, None], moved, ahead[:, t - 1])
        total = _log_sum(ahead[:, -1], 1)
        behind = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            moved = _log_sum(pair + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(real[:, t + 1, None], moved, 0)
        chance = np.exp(ahead + behind - total[:, None, None])
        joint = np.exp(
            ahead[:, :-1, :, None] + pair + (score + behind)[:, 1:, None, :] - total[:, None, None, None]
        )
        slopes = [
            np.bincount(used, np.repeat((label - chance[:, :, 1])[real], sizes), len(names)) / n
            - 1e-3 * weight,
            (seen_pair - joint[both].sum(0)) / n - 1e-3 * pair,
            (seen_start - chance[:, 0].sum(0)) / n - 1e-3 * start,
        ]
        for value, slope, (mean, spread) in zip(values, slopes, state):
            mean += 0.1 * (slope - mean)
            spread += 0.01 * (slope**2 - spread)
            value += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-6)
    weight = {f: float(w) for f, w in zip(names, values[0])}
    return Field(weight, values[1], values[2])


def trained(count: int = TRAINING_PAGES) -> Field:
    """The field trained on the labelled pages."""
    pages = []
    for page, labels in labelled_pages(count):
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError("a labelled page was read into other blocks than it was written in")
        pages.append((features(found), labels))
    return train(pages)


def main_text(page: str, field: Field) -> str:
    found = blocks(page)
    chosen = field.labels(features(found))
    return "\n\n".join(b.text for b, keep in zip(found, chosen) if keep)


def extracted(
    pages: DataFrame,
    field: Field | None = None,
    source: str = "html",
    keep: list[str] | None = None,
    name: str = "text",
) -> DataFrame:
    """`keep` (all columns if not given) and the main text of each page."""
    model = field or trained()

    def compute(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([main_text(t or "", model) for t in texts.to_pylist()], pa.string())]

    return append(pages, compute, f"`{name}` string", source, keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages, keep=["page_id", "url"]).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
