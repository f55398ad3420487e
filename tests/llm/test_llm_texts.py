"""BPE, chat formatting, licence scans and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ladderlake.llm import bpe, chat_format, decontaminate, license_scan

DOCS = "doc_id bigint, text string, lang string, hits string, ids string, score double"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "x", "y", 0.5) for i, t in texts], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


EDGE = [(1, None), (2, ""), (3, " \n"), (4, "x"), (4, "x"), (None, "a b"), (5, "word " * 60_000), (6, "y" * 30_000)]


# --- BPE ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.default_vocabulary())


def chunks_of(text):
    return bpe.chunked(pa.array([text]))[0]


PIECES = ["word", " ", "  ", "\n", "\t \n", "don't", "'s", "É", "日本語", "12", "<|endoftext|>", "<|endof", "🙂", "\x1c", " ", "...", "a" * 700, "́"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=12)), max_size=120), st.integers(0, 40))
def test_ids_agree_with_the_library_for_any_cuts(library, codec, pieces, seed):
    text = "".join(p for p in pieces).encode("utf-8", "ignore").decode()
    rng = random.Random(seed)
    places = sorted({0, len(text), *(rng.randint(0, len(text)) for _ in range(rng.randint(0, 12)))})
    cut = [text[a:b] for a, b in zip(places, places[1:])]
    want = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(cut) == want
    assert codec.encode(chunks_of(text)) == want
    assert codec.decode(want) == library.decode(want, skip_special_tokens=False) == text


SCRIPTS = {  # letters, then marks and punctuation of scripts without spaces
    "chinese": ("的一是不了人我在有他这中大来上国", "，。！？；：「」（）、"),
    "japanese": ("ひらがなカタカナ日本語文章々ー", "、。「」！？（）・"),
    "thai": ("กขคงจฉชซญดตถทนบปผพฟมยรลวสหอเแโไใาะำ", "ัิีึืุู่้๊๋็์"),
    "korean": ("한국어문장이다그리고", "，。！？"),
}
ODD = ["<|endoftext|>", "<|endof", "'s", "'", "12", "\n", " ", "a", "\u0301", "🙂"]


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(sorted(SCRIPTS)), st.integers(0, 10**6))
def test_scripts_without_spaces_agree_with_the_library(library, codec, script, seed):
    rng = random.Random(seed)
    letters, others = SCRIPTS[script]
    kinds = rng.choices([letters, others, ODD], [8, 3, rng.choice([0, 2])], k=rng.randint(0, 300))
    text = "".join(rng.choice(k) for k in kinds)
    places = sorted({0, len(text), *(rng.randint(0, len(text)) for _ in range(rng.randint(0, 12)))})
    cut = [text[a:b] for a, b in zip(places, places[1:])]
    want = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(cut) == codec.encode(chunks_of(text)) == want
    assert codec.decode(want) == text


@pytest.mark.parametrize("script", sorted(SCRIPTS))
def test_chunks_of_scripts_without_spaces_have_firm_places(codec, script):
    rng = random.Random(1)
    letters, others = SCRIPTS[script]
    text = "".join(rng.choice(others if i % 9 == 8 else letters) for i in range(20_000))
    chunks = chunks_of(text)
    assert len(chunks) > 5
    assert sum(codec.chunk(c) is not None for c in chunks) >= 0.9 * len(chunks)


def test_decoder_replaces_bad_bytes_as_the_library_does(library, codec):
    ids = library.encode("日本🙂é").ids
    for i in range(len(ids)):
        part = ids[:i] + ids[i + 1 :]
        assert codec.decode(part) == library.decode(part, skip_special_tokens=False)


def test_chunks_are_shared_between_texts_and_the_dictionary_is_bounded(codec, monkeypatch):
    shared = " ".join(f"w{i * 7919 % 100_003}" for i in range(3_000))
    a, b = chunks_of("one " + shared), chunks_of("quite another start " + shared)
    assert len(set(a) & set(b)) >= len(a) - 2
    monkeypatch.setattr(bpe, "DICTIONARY_IDS", 10)
    assert codec.encode(a) == codec.plain("one " + shared)
    assert len(codec.chunks) <= 2


def test_bpe_of_edge_cases(spark, library):
    want = []
    for doc, text in EDGE:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha(",".join(map(str, ids))), sha(text or "")))
    got = bpe.digests(documents(spark, EDGE)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.digests(documents(spark, [])).count() == 0
    there = bpe.decoded(bpe.encoded(documents(spark, EDGE), name="given"), ids="given", name="back")
    assert all((r.text or "") == r.back and r.ids == "y" for r in there.collect())


# --- chat formatting ------------------------------------------------------------------------------


def chat_rows(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "conv_id bigint, turn bigint, role string, text string, formatted string, learned int",
    )


def brute_chat(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    groups = {}
    for conv, _, role, text in sorted(rows, key=key):
        groups.setdefault(conv, []).append((role or "", text or ""))
    out = []
    for conv, turns in groups.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


CONTROL = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<\\s>", "[\\INST]", "é\n", " [/INST] ", "ok", "", "\0", "<", "s>", "</", "[/"]


def test_conversations_read_back_from_the_output(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(CONTROL) for _ in range(rng.randint(0, 8)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "[INST]", ""]), text))
    rows += [(70, 0, None, None), (70, 0, "assistant", "tie"), (70, 0, "assistant", "tie"), (70, None, "user", "x")]
    rows += [(None, 1, "assistant", "b"), (None, 0, "user", "a"), (71, 0, "assistant", "long " * 100_000)]
    rows += [(72, t, "assistant", f"t{t}") for t in range(3_000)]
    formatted = chat_format.format_turns(chat_rows(spark, rows)).persist()
    got = chat_format.digests(formatted).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_chat(rows)
    inner = formatted.collect()
    for r in inner:  # control strings stand only where the template puts them
        body = r.formatted[len("<s>[INST] ") : -len("</s>")]
        assert sum(body.count(c.decode()) for c in chat_format.CONTROLS) == 1
    assert {r.conv_id: r.formatted_chars for r in got}[72] == sum(len(r.formatted) for r in inner if r.conv_id == 72)
    formatted.unpersist()
    assert chat_format.digests(chat_format.format_turns(chat_rows(spark, []))).count() == 0


def test_the_query_adds_the_probe_conversation(spark, sf):
    got = {r.conv_id: r for r in chat_format.query(spark, sf).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got[-1].n_turns == 2 and got[-1].loss_sha256 == sha(said)
    assert got[-1].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r)[:5] for c, r in got.items() if c != -1), key=repr) == brute_chat(rows)


# --- licence scans ----------------------------------------------------------------------------------


def brute_scan(doc, text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = sorted(
        (i, label)
        for phrase, label in license_scan.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    )
    ends = (places[0][0], places[-1][0]) if places else (None, None)
    return doc, len(words), len(places), *ends, ",".join(sorted({p[1] for p in places}))


def test_base_phrases_against_brute_force(spark):
    rng = random.Random(8)
    words = ["CC", "by", "cc BY", "General", "public", "License", "gnu", "all rights", "reserved", "é", "nc", "xcc", "-", "\n", "Ü"]
    texts = [(i, rng.choice(["", " "]).join(rng.choice(words) + rng.choice([" ", "-", "", "\n"]) for _ in range(rng.randint(0, 25)))) for i in range(400)]
    texts += EDGE + [(900, "cc by cc by"), (901, "cc"), (902, "by"), (903, "all rights reserved all rights reserved.")]
    got = license_scan.scanned(documents(spark, texts)).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((brute_scan(*t) for t in texts), key=repr)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert license_scan.scanned(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("expression", "order", "asks"),
    [
        ("MIT", ["mit"], 0.1),
        ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only", "or"], 0.1),
        ("MIT AND GPL-3.0-only", ["mit", "gpl-3.0-only", "and"], 0.6),
        ("GPL-2.0 WITH Classpath-exception-2.0", ["gpl-2.0", "classpath-exception-2.0", "with"], 0.3),
        ("MIT OR Apache-2.0 AND GPL-2.0", ["mit", "apache-2.0", "gpl-2.0", "and", "or"], 0.1),
        ("(MIT OR Apache-2.0) AND GPL-2.0", ["mit", "apache-2.0", "or", "gpl-2.0", "and"], 0.6),
        ("((MIT)) and (bsd-3-clause or ISC)", ["mit", "bsd-3-clause", "isc", "or", "and"], 0.1),
        ("MIT OR", ["mit"], 0.1),
        ("MIT) x", ["mit"], 0.1),
        ("Apache-2.0 */ and more", ["apache-2.0", "more", "and"], 0.5),
    ],
)
def test_expressions(expression, order, asks):
    assert license_scan.postfix(expression) == order
    assert license_scan.evaluate(expression)[1] == pytest.approx(asks)


def test_expressions_that_hold_nothing():
    assert license_scan.evaluate("") is None
    assert license_scan.evaluate(") (") is None
    assert license_scan.evaluate("see the file") is None


def test_tags_give_labels(spark):
    texts = [(1, "// SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode CC BY"), (2, "SPDX-License-Identifier:"), (3, "spdx license identifier GPL")]
    got = {r.doc_id: r for r in license_scan.scanned(documents(spark, texts)).collect()}
    assert got[1].labels == "apache-2.0,cc-by,mit" and got[1].base_labels == "cc-by" and got[1].score == 0.3
    assert got[2].labels == "" and got[3].labels == ""


def test_identifiers_that_are_not_known():
    evaluate = license_scan.evaluate
    assert evaluate(" EUPL-1.2", True) == ({"eupl-1.2"}, license_scan.UNKNOWN)
    assert evaluate("MIT OR EUPL-1.2", True) == ({"mit", "eupl-1.2"}, 0.1)
    assert evaluate("(SSPL-1.0 AND MIT) OR LicenseRef-x WITH y-exception", True)[1] == 0.25
    assert evaluate("GPL-2.0 WITH a-exception AND (MIT OR x-1)", True) == ({"gpl-2.0", "mit", "x-1"}, 0.3)
    assert evaluate("see the file", True) is None
    assert evaluate("proprietary", True)[0] == {"proprietary"}
    assert evaluate("EUPL-1.2") is None
    assert evaluate("MIT OR EUPL-1.2")[0] == {"mit", "eupl-1.2"}
    assert evaluate("MIT or whatever else you like")[0] == {"mit"}


def test_further_tags(spark):
    texts = {
        1: "License: MIT OR Apache-2.0\nmore",
        2: '  "license": "MIT AND EUPL-1.2",',
        3: "License-Expression: EUPL-1.2",
        4: "its license: MIT",
        5: "License: see the file",
        6: "# Licence: BSD-3-Clause",
        7: "License\n: MIT",
        8: "x\n * SPDX-License-Identifier: SSPL-1.0 AND MIT\n",
        9: "License: é MIT",
        10: "License-Expression: EUPL-1.2 " * 3_000,
        11: None,
    }
    got = {r.doc_id: r for r in license_scan.scanned(documents(spark, texts.items())).collect()}
    assert {k: r.labels for k, r in got.items()} == {
        1: "apache-2.0,mit", 2: "eupl-1.2,mit", 3: "eupl-1.2", 4: "", 5: "", 6: "bsd-3-clause",
        7: "", 8: "mit,sspl-1.0", 9: "mit", 10: "eupl-1.2", 11: "",
    }
    assert got[3].score == got[8].score == license_scan.UNKNOWN and got[2].score == 0.5
    assert not any(r.base_labels for r in got.values())


# --- decontamination ---------------------------------------------------------------------------------


def fewest_edits(item, text):
    """Edit distance of the item to the nearest stretch of the text."""
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j - 1] + (a != b), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def read(text):
    return " ".join(re.findall(r"(?:[^\W_]|[^\x00-\x7f])+", (text or "").lower()))


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out) or 1)
        out = out or ["q"]
        kind = rng.random()
        if kind < 0.34:
            out[i] = rng.choice("qxzj")
        elif kind < 0.67:
            out.insert(i, rng.choice("qxzj"))
        else:
            del out[i]
    return "".join(out)


def test_hits_are_those_of_brute_force(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(4, 40))) for i in range(14)] + [(50, "yes"), (51, None), (52, ""), (None, text(20)), (53, "Dup " + text(9))]
    items.append((54, items[-1][1]))
    docs = []
    for n in range(90):
        item = rng.choice(items)[1] or "none"
        body = edited(rng, item or "x", rng.randint(0, 5)) if n % 3 else item.upper().replace(" ", " -\n")
        docs.append((n, text(rng.randint(0, 60)) + rng.choice([" ", ""]) + body + " " + text(rng.randint(0, 30))))
    docs += EDGE + [(200, items[3][1]), (201, items[3][1] + " " + items[3][1]), (202, text(20_000) + " " + items[5][1])]
    found = decontaminate.hits(documents(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r.doc_id, r.item_id): r.edits for r in found.collect()}
    want = {}
    for doc, body in docs:
        if len(body or "") > 20_000:
            continue
        for number, item in items:
            plain = read(item)
            if len(plain) < decontaminate.LEAST_CHARS:
                continue
            budget = min(int(decontaminate.EDIT_RATE * len(plain)), (len(plain) - decontaminate.Q) // decontaminate.Q)
            edits = fewest_edits(plain, read(body))
            if edits <= budget:
                want[(doc, number)] = edits
    assert (202, 5) in got and len(want) > 60
    assert {k: v for k, v in got.items() if k[0] != 202} == want


def test_clean_documents_stay(spark):
    item = "the quick brown fox jumps over the lazy dog again and again"
    docs = documents(spark, [(1, item), (2, "nothing of it"), (3, None), (None, "x " + item.upper() + " y")])
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.keep_clean(docs, none).count() == 4
    assert decontaminate.hits(docs, none).count() == 0
    assert decontaminate.hits(documents(spark, []), bench).count() == 0


def test_blocks_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    items = [(i, f"item number {i} has the words " + "abcdefgh"[i] * 12 + " and " + "hgfedcba"[i] * 9) for i in range(8)]
    docs = documents(spark, [(i, f"so {t} it says") for i, t in items])
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.hits(docs, bench).collect()
    assert {(i, i) for i, _ in items} <= {(r.doc_id, r.item_id) for r in got}


def some_words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_parts_of_items_are_those_of_brute_force(spark):
    rng = random.Random(17)
    size = decontaminate.STRETCH_CHARS
    budget = int(decontaminate.budget_of(size))
    items = [(i, some_words(rng, n)) for i, n in enumerate([9, 12, 16, 20, 26, 32])]
    docs = []
    for n in range(36):
        plain = items[n % 6][1]
        if n % 3 == 0:  # a part, of about the size of a stretch
            begin = rng.randint(0, max(0, len(plain) - size))
            body = edited(rng, plain[begin : begin + size + rng.randint(-4, 3)], rng.randint(0, 4))
        elif n % 3 == 1:  # several words changed
            words = plain.split()
            for at in rng.sample(range(len(words)), min(len(words), rng.randint(2, 5))):
                words[at] = "q" * rng.randint(2, 9)
            body = " ".join(words)
        else:  # cut short at one end, or parted by other words
            cut = len(plain) * rng.randint(50, 90) // 100
            body = rng.choice([plain[:cut], plain[-cut:], plain[: cut // 2] + " qqq " * 9 + plain[cut // 2 :]])
        docs.append((n, some_words(rng, 5) + " " + body + " " + some_words(rng, 3)))
    docs += [(100 + n, some_words(rng, 40)) for n in range(4)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.hits(documents(spark, docs), bench, parts=True)
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    want, parts = set(), 0
    for doc, body in docs:
        text = read(body)
        for number, item in items:
            plain = read(item)
            whole = fewest_edits(plain, text) <= int(decontaminate.budget_of(len(plain)))
            starts = range(len(plain) - size + 1) if not whole and doc % 6 == number and doc < 100 else ()
            edits = [fewest_edits(plain[s : s + size], text) for s in starts]
            if whole or (edits and min(edits) <= budget):
                want.add((doc, number))
                r = got[(doc, number)]
                assert fewest_edits(plain[r.item_from : r.item_to], text[r.text_from : r.text_to]) == r.edits
                assert r.item_chars == len(plain)
                if not whole:
                    parts += 1
                    assert r.edits == min(edits) and r.item_from == edits.index(min(edits)) and r.item_to - r.item_from == size
                else:
                    assert (r.item_from, r.item_to) == (0, len(plain))
    assert set(got) == want and parts > 10 and len(want) < 37


def test_truncated_and_reworded_items_go_and_clean_documents_stay(spark):
    rng = random.Random(3)
    words = some_words(rng, 40).split()
    item = " ".join(words)
    reworded = " ".join("changed" if i in (3, 4, 17, 30, 31) else w for i, w in enumerate(words))
    texts = [
        (1, "so " + " ".join(words[:25])),  # without its end
        (2, " ".join(words[15:]).upper() + " and on"),  # without its beginning
        (3, " ".join(words[:18]) + "\n-- page 2 of the exam paper, continued --\n" + " ".join(words[18:])),
        (4, reworded),
        (5, " ".join(words[:6]) + " is how it begins"),  # a short quote
        (6, " ".join(f"{w} other" for w in words)),
        (7, " ".join(sorted(words))),
        (8, some_words(rng, 80)),
        (9, None),
    ]
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    assert len(" ".join(words[:6])) < decontaminate.STRETCH_CHARS
    kept = decontaminate.keep_clean(documents(spark, texts), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6, 7, 8, 9]


def test_short_items_are_found_by_equality(spark):
    items = [(1, "Yes"), (2, "Who is he?"), (3, "日本の首都はどこですか？"), (4, "no, no."), (5, "..."), (6, "是的"), (7, "Oh! Who are you")]
    texts = [
        (1, " YES. \n"),
        (2, "Yes. It is so, yes\nyes\n"),
        (3, "It began.\nWho is -- he?\nNobody knew"),
        (4, "they asked who is he and went on"),
        (5, "Q: who is he"),
        (6, "who is hey. xwho is he. who is he then"),
        (7, "問題。日本の首都はどこですか。答え"),
        (8, "是的，他说"),
        (9, "是的"),
        (10, "... \n"),
        (11, None),
        (12, "No no"),
        (13, "So he said oh! Who are you?"),
        (14, 'He said: "Oh! Who are you?" and left'),
        (15, "who is"),
        (16, "he? who is"),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = documents(spark, texts)
    found = decontaminate.hits(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (3, 2), (5, 2), (7, 3), (9, 6), (12, 4), (14, 7)}
    plain = {d: read(t) for d, t in texts}
    assert plain[3][next(r for r in found if r.doc_id == 3).text_from :].startswith("who is he nobody")
    kept = {r.doc_id for r in decontaminate.keep_clean(docs, bench).collect()}
    assert kept == {2, 4, 6, 8, 10, 11, 13, 15, 16}
