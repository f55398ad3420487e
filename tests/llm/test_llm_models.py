"""Trained operators: held-out accuracy, edge cases; the pipeline against its parts."""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ladderlake.llm import (
    bpe,
    decontaminate,
    html_crf,
    page_samples,
    quality_gam,
    registry,
    toxicity_fm,
)
from test_llm_dedup import normal, simple_fingerprint, union

MIDDLE, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
DOCS = "doc_id bigint, text string, lang string, score double, label int, buckets string"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", 0.5, 3, "x") for i, t in texts], DOCS)


EDGE = [(1, None), (2, ""), (3, "!!! ???"), (4, "one"), (4, "one"), (None, "a b"), (5, "word " * 40_000), (6, "\n\n"), (7, "É" * 9)]


@pytest.mark.parametrize(
    ("module", "label", "folds", "held", "accuracy", "sf"),
    [(quality_gam, "quality", 5, 0, 0.95, MIDDLE), (toxicity_fm, "toxic", 4, 2, 0.96, LARGE)],
)
def test_held_out_accuracy(spark, module, label, folds, held, accuracy, sf):
    got = module.query(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    own = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(own) > 50
    assert np.mean([r.predicted == truth[r.doc_id] for r in own]) >= accuracy


@pytest.mark.parametrize(("module", "label"), [(quality_gam, "quality"), (toxicity_fm, "toxic")])
def test_classifier_edge_cases(spark, module, label):
    docs = documents(spark, EDGE)
    schema = f"doc_id bigint, {label} int, text string"
    for given in ([], [(4, 1, "x")], [(4, None, "x"), (None, 1, "x")], [(1, 1, "x"), (2, 0, ""), (3, 1, ""), (7, 0, ""), (7, 1, "")]):
        got = module.classify(docs, spark.createDataFrame(given, schema)).collect()
        assert sorted((r.doc_id for r in got), key=repr) == sorted((i for i, _ in EDGE), key=repr)
        assert len({r.score for r in got if r.doc_id == 4}) == 1
        if not given:
            assert {r.score for r in got} == {0.5}
    assert module.classify(documents(spark, []), spark.createDataFrame([(1, 1, "")], schema)).count() == 0


def test_held_out_labels_are_never_learned_from(spark):
    docs = documents(spark, [(i, f"text {i} " * (i % 9 + 1)) for i in range(60)])
    for module, label, folds, held in ((quality_gam, "quality", 5, 0), (toxicity_fm, "toxic", 4, 2)):
        out = []
        for flip in (0, 1):
            rows = [
                (i, (i % 2) ^ (flip if zlib.crc32(str(i).encode()) % folds == held else 0)) for i in range(60)
            ]
            labels = spark.createDataFrame(rows, f"doc_id bigint, {label} int")
            out.append(sorted(map(tuple, module.classify(docs, labels).collect())))
        assert out[0] == out[1]


def test_pairs_of_features_are_learned():
    rng = np.random.default_rng(0)
    rows = rng.random((3_000, 3))
    label = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)  # no single feature tells
    model = quality_gam.fit(rows[:2_000], label[:2_000])
    assert np.mean((model.score(rows[2_000:]) > 0.5) == label[2_000:]) > 0.9
    assert {model.pairs[0][0], model.pairs[0][1]} == {0, 1}


def test_pairs_of_terms_are_learned():
    rng = np.random.default_rng(0)
    inputs = (rng.random((4_000, 12)) < 0.4).astype(np.float32)
    label = (inputs[:, 0] * inputs[:, 1]).astype(float)
    machine = toxicity_fm.fit(inputs[:3_000], label[:3_000], np.arange(12))
    doc, term = np.nonzero(inputs[3_000:])
    assert np.mean((machine.score(doc, term, 1_000) > 0.5) == label[3_000:]) > 0.97
    assert machine.factor[0] @ machine.factor[1] > 0


def test_scores_are_those_of_a_double_loop_over_pairs():
    rng = np.random.default_rng(3)
    inputs = (rng.random((400, 9)) < 0.4).astype(np.float32)
    label = np.maximum(inputs[:, 0] * inputs[:, 1], inputs[:, 5]).astype(float)
    buckets = np.arange(9) * 5 + 2
    machine = toxicity_fm.fit(inputs, label, buckets)
    texts = [rng.choice(60, rng.integers(0, 30)).tolist() for _ in range(80)]  # repeats, others
    doc = np.array([i for i, t in enumerate(texts) for _ in t], np.int64)
    got = machine.score(doc, np.array([b for t in texts for b in t], np.int64), len(texts))
    place = {int(b): i for i, b in enumerate(machine.buckets)}
    for text, score in zip(texts, got):
        own = sorted({place[b] for b in text if b in place})
        raw = machine.bias + sum(machine.weight[i] for i in own)
        raw += sum(machine.factor[i] @ machine.factor[j] for i in own for j in own if i < j)
        assert score == pytest.approx(1 / (1 + np.exp(-raw)), abs=1e-12)
    assert len({round(s, 9) for s in got}) > 10


def test_scores_are_those_of_table_look_ups():
    rng = np.random.default_rng(4)
    rows = np.round(rng.random((900, 4)), 2)  # values that lie on cuts, too
    label = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.3) | (rows[:, 3] > 0.9)).astype(float)
    model = quality_gam.fit(rows, label)
    assert model.pairs

    def bin_of(edges, value):
        return sum(1 for edge in edges if edge <= value)

    for row, score in zip(rows[:200], model.score(rows[:200])):
        raw = model.base
        for j, table in enumerate(model.tables):
            raw += table[bin_of(model.edges[j], row[j])]
        for a, b, table in model.pairs:
            raw += table[bin_of(model.coarse[a], row[a])][bin_of(model.coarse[b], row[b])]
        assert score == pytest.approx(1 / (1 + np.exp(-raw)), abs=1e-12)


# --- HTML -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def field():
    return html_crf.trained()


def test_held_out_pages(field):
    wrong = total = 0
    for page, labels in page_samples.labelled_pages(150, seed=50_000):
        found = html_crf.blocks(page)
        assert len(found) == len(labels)
        wrong += sum(a != b for a, b in zip(field.labels(html_crf.features(found)), labels))
        total += len(labels)
    assert wrong / total < 0.02


def article_of(page):
    """The article of a page as the given tables lay it out."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [re.sub(r"<[^>]*>", " ", x) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


def test_given_pages_are_extracted_exactly(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    for r in html_crf.query(spark, MIDDLE).collect():
        assert r.text == article_of(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_blocks_of_odd_markup():
    page = (
        "<body>top<p class='x y'>a &amp b&nbsp;<br>c<p>d <a href=\"?a>b\">link</a><ul><li>1<li>2</ul>"
        "<script>if (a < b) '<p>no</p>'</script><!-- <p>no</p> --><div title=it's>it's</div></p></x>"
        "<textarea>no</textarea><td>cell &lt;p&gt; &#233;</td> 1 < 2 <style>p{}"
    )
    found = html_crf.blocks(page)
    assert [b.text for b in found] == ["top", "a & b c", "d link", "1", "2", "it's", "cell <p> é", "1 < 2"]
    assert found[1].path[-1] == "p x y" and found[2].linked == 4
    assert html_crf.blocks("") == [] and html_crf.blocks("<p>") == []


def test_viterbi_is_the_best_labelling(field):
    rows = [["bias", "tag:p"], ["bias", "in:nav"], ["size:3"], ["links:all", "copyright"], ["tag:h1", "in:article"]]
    def value(labels):
        total = field.start[labels[0]]
        for i, label in enumerate(labels):
            total += label * sum(field.weight.get(f, 0) for f in rows[i])
            total += field.pair[labels[i - 1], label] if i else 0
        return total
    best = max(([int(b) for b in f"{n:05b}"] for n in range(32)), key=value)
    assert field.labels(rows) == best


def test_page_edge_cases(spark, field):
    long = "<article><p>" + "long text, " * 60_000 + "</p></article>"
    rows = [(1, None, None, 1), (2, "u", "", 1), (3, "u", "plain", 1), (None, None, long, 1), (4, "u", "<nav><a>x</a></nav>", 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = html_crf.extracted(pages, field, keep=["page_id", "url"], name="main").collect()
    texts = {r.page_id: r.main for r in got}
    assert texts[1] == texts[2] == texts[4] == "" and len(texts[None]) == len("long text, ") * 60_000 - 1
    assert html_crf.extracted(pages.limit(0), field, name="main").count() == 0


# --- pipeline ---------------------------------------------------------------------------------------


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    columns = docs.columns
    scores = {r.doc_id: r.predicted for r in quality_gam.query(spark, MIDDLE).collect()}
    want = {r.doc_id: r.text for r in docs.collect() if scores[r.doc_id]}
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, MIDDLE)
        results.append((name, {r.doc_id: r for r in docs.collect()}))
        if name != "bpe":
            assert docs.columns == columns
    assert set(results[0][1]) == set(want)
    first = {}
    for doc, text in sorted(want.items()):
        first.setdefault(normal(text), doc)
    want = {d: want[d] for d in first.values()}
    assert set(results[1][1]) == set(want)
    prints = {d: simple_fingerprint(t) for d, t in want.items()}
    close = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    root = union(close, prints)
    want = {d: t for d, t in want.items() if root[d] == d}
    assert set(results[2][1]) == set(want)
    items = [decontaminate_read(r.text) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    leaks = {d for d, t in want.items() if any(i in decontaminate_read(t) for i in items)}
    assert leaks and not leaks & set(results[3][1])
    assert set(results[3][1]) <= set(want)
    assert len(set(want) - set(results[3][1])) <= len(leaks) + 2
    own = {r.doc_id: tuple(r) for r in bpe.query(spark, MIDDLE).collect()}
    assert {d: tuple(r) for d, r in results[4][1].items()} == {d: own[d] for d in results[3][1]}
    ran = {r.doc_id: tuple(r) for r in corpus_pipeline.run(spark, MIDDLE).collect()}
    assert ran == {d: tuple(r) for d, r in results[4][1].items()}


def decontaminate_read(text):
    return " ".join(re.findall(r"(?:[^\W_]|[^\x00-\x7f])+", text.lower()))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0, name


def test_all_ten_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_sql_of_exact_dedup(spark, sf):
    from check_queries import database, difference

    con = database(sf)
    result = con.execute(registry.ORACLES["op4_exact_dedup"])
    columns = [d[0] for d in result.description]
    df = registry.QUERIES["op4_exact_dedup"](spark, sf)
    assert not difference(df.columns, df.collect(), columns, result.fetchall())


def test_decontamination_budget_matches_the_lemma():
    index = decontaminate.index(((1, "abcdefghij " * 30), (2, "abcdefghijklmnopqrstuvwx")))
    assert (index.least >= 1).all() and index.budget.tolist() == [16, 1]
