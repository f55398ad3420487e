"""Columns of the caller's that are named like the operators' own."""

from __future__ import annotations

import subprocess
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ladderlake.llm import common, decontaminate, html_crf

NAMES = (
    "marked_id", "marked_key", "kept", "n", "__key", "__id", "__row", "__text", "___text", "__quality",
    "__leaks", "__hits0", "__read", "key", "fp", "hash", "norm", "keep_id", "text_sha256", "label",
    "features", "score", "hits", "smallest", "root", "first", "th", "cuts", "MARKED_ID", "a b",
)


@pytest.fixture(scope="module")
def docs(spark, sf):
    plain = spark.read.parquet(f"{sf}/documents.parquet")
    both = [n for n in NAMES if n != "MARKED_ID"]
    return plain, plain.select("*", *[F.lit(n).alias(n) for n in both])


@pytest.mark.parametrize("number", range(4))
def test_stages(spark, sf, docs, number):
    plain, named = docs
    stage = corpus_pipeline.STAGES[number][1]
    got = stage(spark, named, sf)
    assert got.columns == named.columns
    want = sorted(r[0] for r in stage(spark, plain, sf).select("doc_id").collect())
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == want
    assert all(r[n] == n for r in rows for n in ("marked_id", "__text", "a b"))


def test_unused():
    assert common.unused(["A", "_b", "b"], "a", "b", "c", "c") == ["_a", "__b", "c", "_c"]


# --- opaque elements ------------------------------------------------------------------------


def text_of(page):
    return [b.text for b in html_crf.blocks(page)]


@pytest.mark.parametrize("tag", ["button", "svg", "select", "object", "canvas", "script", "datalist"])
def test_an_unclosed_opaque_element_keeps_the_text_behind_it(tag):
    page = f"<article><p>one</p><{tag}>go<p>two</p></article><p>three</p>"
    assert text_of(page) == ["one", "two", "three"]
    closed = f"<article><p>one</p><{tag}>go</{tag}><p>two</p></article>"
    assert text_of(closed) == ["one", "two"]


def test_flat_elements_that_another_follows():
    page = "<p>a</p><button>x<p>b</p><button>y</button><p>c</p>"
    assert text_of(page) == ["a", "b", "c"]
    assert text_of("<p>a</p><script>if (a < b) '<p>no</p>'</script><p>b</p>") == ["a", "b"]


def test_formulas_stay():
    assert text_of("<article><p>a <math><mi>x</mi></math> b</p></article>") == ["a x b"]
    assert text_of("<article><p>a <math><mi>x</mi> b</p><p>c</p></article>") == ["a x b", "c"]


def test_the_copyright_sign_counts_wherever_it_is():
    block = html_crf.Block("word " * 200 + "© 2020", ("p",), 0)
    assert "copyright" in html_crf._text_features(block, 0, 1)


# --- repeated text ----------------------------------------------------------------------------


def test_rounds_change_no_hit(monkeypatch):
    item = "the quick brown fox " * 6 + "jumps over the lazy dog and runs away"
    texts = ["a b c " * 50 + item + " tail " * 30, "0" * 400, item[:90] + " x " + item[40:], "none", item * 3]
    items = ((1, item), (2, "0" * 200), (3, "0" * 150 + " other words that are nowhere else to be found"))
    want = list(decontaminate.Index(items).hits(pa.array(texts), True))
    assert want[0] and want[1] and want[4]
    for pairs in (2_000, 20_000):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        assert list(decontaminate.Index(items).hits(pa.array(texts), True)) == want


def test_memory_on_a_long_text_of_one_character():
    code = (
        "import pyarrow as pa, resource\n"
        "from ladderlake.llm import decontaminate as d\n"
        "index = d.Index(((1, '0' * 200),))\n"
        "list(index.hits(pa.array(['0' * 1000]), True))\n"
        "before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\n"
        "found = list(index.hits(pa.array(['0' * 120_000]), True))\n"
        "assert found[0][0][:2] == (1, 0)\n"
        "print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, check=True,
        cwd=corpus_pipeline.__file__.rsplit("/", 1)[0],
    )
    assert int(done.stdout) < 500
