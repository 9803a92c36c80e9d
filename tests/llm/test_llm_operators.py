"""Each operator against a plain Python version, on awkward documents."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import html_text, licences, neardup, neighbours, packing, pieces, quality, rules, tokens, toxicity
from starmill.llm.components import components
from starmill.llm.encoder import WordEncoder
from starmill.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, WORD_TOKENIZER, tokenizer_file
from starmill.sources.scratch import scratch_folder, written


@pytest.fixture(scope="module")
def rows():
    return fixtures.awkward_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return written(fixtures.frame(spark, rows), "fixture")


@pytest.fixture(scope="module")
def none(spark):
    return fixtures.frame(spark, [])


def as_is(name):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs, rows, none):
    path = scratch_folder(spark, "tokens")
    tokens.write_tokens(docs, path, tokenizer_file(WORD_TOKENIZER), 2)
    encode, start = as_is(WORD_TOKENIZER), 0
    expected = []
    for doc_id, text, *_ in rows:
        ids = [*encode(text), 2]
        expected.append((doc_id, start, len(ids), checksum(ids)))
        start += len(ids)
    assert [tuple(r) for r in tokens.token_digest(spark, path).orderBy("doc_id").collect()] == expected
    one = tokens.read_tokens(spark, path).filter("doc_id = 7").first()
    assert one["tokens"] == [*encode(rows[7][1]), 2]
    empty = scratch_folder(spark, "tokens")
    tokens.write_tokens(none, empty, tokenizer_file(WORD_TOKENIZER), 2)
    assert tokens.token_digest(spark, empty).isEmpty()


@pytest.mark.parametrize("name, spaces", [(WORD_TOKENIZER, "drop"), (BYTE_TOKENIZER, "lead")])
def test_letters_that_normalise_to_letter_and_mark(name, spaces):
    import unicodedata

    split = [c for c in map(chr, range(0x110000)) if c.isalpha() and not unicodedata.normalize("NFC", c).lower().isalpha()]
    assert "\u0958" in split and "\u09df" in split and "\ufb4e" in split and "\u0130" in split
    encode = as_is(name)
    texts = [f"house {c}ab tree\n{c} ab{c}. \u09b9{c}!? end." for c in split]
    own = WordEncoder(tokenizer_file(name), spaces)
    for found in (own.encode(texts), own.encode(texts), own.encode(["house tree\nend ab"] * 2)):
        texts = texts if len(found) == len(texts) else ["house tree\nend ab"] * 2
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [encode(t) for t in texts]


@pytest.mark.parametrize("name, spaces", [(WORD_TOKENIZER, "drop"), (BYTE_TOKENIZER, "lead")])
def test_group_with_other_pre_tokens_is_encoded_alone(name, spaces, monkeypatch):
    from starmill.llm import encoder

    monkeypatch.setattr(encoder, "_normal", str.lower)  # as if the letter were unknown
    text = "a house \u0958ab tree \u09b9\u09df of wood"
    found = WordEncoder(tokenizer_file(name), spaces).encode([text])
    assert np.frombuffer(found[0], "<u4").tolist() == as_is(name)(text)


@pytest.mark.parametrize("name, spaces", [(WORD_TOKENIZER, "drop"), (BYTE_TOKENIZER, "lead")])
def test_random_strings_as_the_library(name, spaces):
    """NUL, names of special tokens, contractions and odd white space, with a small cache."""
    draw = random.Random(3)
    parts = [*"abXY  \n\n\t.,!'sé\0", "\u00a0", "\u3000", "\u0958", "\u09df", "İ", "日本", "<|endoftext|>",
             "<|startoftext|>", "'ll", "1", "23", "\u0301", "\r", "\x0b", "\x1c", "the", "house", "#$"]
    encode, own = as_is(name), WordEncoder(tokenizer_file(name), spaces, kept=40)
    for _ in range(30):
        texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(100)]
        found = own.encode([*texts, None, " \0"])
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == [encode(t) for t in [*texts, "", " \0"]]


def test_token_files_of_repeated_rows(spark, docs, rows):
    path = scratch_folder(spark, "tokens")
    tokens.write_tokens(docs.unionByName(docs), path, tokenizer_file(WORD_TOKENIZER), 2)
    read = tokens.token_digest(spark, path).orderBy("start").collect()
    assert len(read) == 2 * len(rows)
    assert [r["doc_id"] for r in read] == sorted(r["doc_id"] for r in read)
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(read, read[1:]))


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, docs, rows, none, capacity):
    cut = written(packing.cut_documents(docs, tokenizer_file(BYTE_TOKENIZER), 0, capacity, with_tokens=True), "cut")
    placed = written(packing.pack(cut, capacity), "placed")
    encode = as_is(BYTE_TOKENIZER)
    per_doc: dict = {}
    for r in placed.collect():
        per_doc.setdefault(r["doc_id"], []).append(r)
    for doc_id, text, *_ in rows:
        own = sorted(per_doc[doc_id], key=lambda r: r["piece"])
        assert [t for r in own for t in r["tokens"]] == [*encode(text), 0]
        assert all(r["length"] == capacity for r in own[1:])
        assert all(checksum(r["tokens"]) == r["ids_crc32"] for r in own)
    for sequence in packing.sequences(placed).collect():
        assert len(sequence["tokens"]) <= capacity and sequence["offsets"][0] == 0
    total = sum(r["length"] for own in per_doc.values() for r in own)
    used = {r["sequence_id"] for own in per_doc.values() for r in own}
    assert len(used) <= 1.3 * -(-total // capacity)
    assert packing.pack_documents(none, tokenizer_file(BYTE_TOKENIZER), 0, capacity).isEmpty()


def test_fullest_bin_takes_a_piece_and_closes_first():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 8, 2, 5)] == [(0, 0), (1, 0), (1, 8), (2, 0)]
    # Bins 0 (4 free) and 2 (5 free) are open; a new one closes bin 0, the fuller.
    assert bins.place(9) == (3, 0)
    assert bins.place(4) == (2, 5)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = {r[0]: shingle_set(r[1]) for r in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if i < j and sets[i] and sets[j] and 4 * common >= 3 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, docs, rows, none):
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs).collect()}
    assert found == brute_components(rows)
    assert neardup.near_duplicates(none).isEmpty()


def test_near_duplicates_of_repeated_rows_and_rows_without_id(spark, docs, rows):
    extra = [(None, "one two", None, None, None), (None, "nothing like it", None, None, None)]
    judged = neardup.near_duplicates(docs.unionByName(docs).unionByName(fixtures.frame(spark, extra)))
    judged = [tuple(r) for r in judged.collect()]
    assert len(judged) == 2 * len(rows) + 2
    assert {r[0]: r[1:3] for r in judged if r[0] is not None} == brute_components(rows)
    assert sorted((r[2] is None, r[3]) for r in judged if r[0] is None) == [(False, False), (True, True)]


def test_near_copies_that_chain(spark):
    """Each text is near the next only, and no pivot is near them all."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[4 * k : 4 * k + 100]), None, None, None) for k in range(60)]
    found = neardup.near_duplicates(fixtures.frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(rows)
    assert len({r["component_id"] for r in found}) == 1


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(99, 98), (98, 98), (7, 7)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {**{i: 1 for i in range(2, 41)}, 99: 98}


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_rules(docs, rows, none):
    judged = rules.judge(docs.unionByName(docs)).collect()
    assert len(judged) == 2 * len(rows)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = {r[0]: base_counts(r[1]) for r in rows}
    for r in judged:
        assert tuple(r[n] for n in names) == expected[r["doc_id"]]
        assert not (r["kept"] and r["base_failed"])
    assert rules.judge(none).isEmpty()


def test_host_rates_shrink_small_hosts(spark):
    good, bad = "a b c d e f g h i j k", "short"
    rows = [(i, bad if i % 10 == 0 else good, None, f"host{i % 7}", None) for i in range(700)]
    rows += [(1000, bad, None, "tiny", None), (1001, good, None, "tiny", None)]
    rows += [(2000 + i, bad if i % 5 else good, None, "bad", None) for i in range(200)]
    judged = {r["doc_id"]: r for r in rules.judge(fixtures.frame(spark, rows)).collect()}
    assert judged[1]["kept"] and not judged[0]["kept"]
    assert 0.1 < judged[1001]["host_rate_base"] < 0.5 and judged[1001]["kept"]
    assert not judged[2000]["kept"] and not judged[2000]["base_failed"]


def test_quality(spark, docs, rows, none):
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, len(rows), 2)] + [(3, None)], "doc_id bigint, quality int")
    judged = quality.classify(docs.unionByName(docs), labels).collect()
    assert len(judged) == 2 * len(rows) and all(0 < r["score"] < 1 for r in judged)
    assert quality.classify(none, labels).isEmpty()
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_posteriors_shrink_paths_to_hosts_to_all(spark):
    rows = [("h1", "p", 1)] * 90 + [("h1", "p", 0)] * 10 + [("h1", "q", 0)] + [("h2", "p", 0)] * 80 + [("h2", "p", 1)] * 20
    labelled = spark.createDataFrame(rows, "host string, path string, quality int")
    hosts, paths, mean = quality.posteriors(labelled)
    host = {r["host"]: r["host_rate"] for r in hosts.collect()}
    path = {(r["host"], r["path"]): r["path_rate"] for r in paths.collect()}
    assert mean == pytest.approx(111 / 203)
    assert 0.2 < host["h2"] < mean < host["h1"] < 0.9
    assert 0 < path["h1", "q"] < host["h1"] and abs(path["h1", "p"] - 0.9) < 0.05


def test_toxicity(spark, rows, none):
    made = [(i, f"{'idiot scum ' if i % 3 == 0 else ''}{r[1] or 'x'} text{i}", None, None, None) for i, r in enumerate(rows * 5)]
    made += [(9000, None, None, None, None), (9001, "", None, None, None), (9002, "some idiots here", None, None, None)]
    docs = fixtures.frame(spark, made)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(len(made) - 3)], "doc_id bigint, toxic int")
    held_out = F.col("doc_id") % 4 == 2
    scored = {r["doc_id"]: r for r in toxicity.score(docs, labels, held_out).collect()}
    assert len(scored) == len(made)
    tested = [i for i in range(len(made) - 3) if i % 4 == 2]
    assert all(scored[i]["predicted"] == int(i % 3 == 0) for i in tested)
    assert scored[9000]["predicted"] == scored[9001]["predicted"] == 0 and not scored[9000]["evidence"]
    assert scored[9002]["predicted"] == 1 and all(e % 3 == 0 for e in scored[9002]["evidence"])
    assert toxicity.score(none, labels, held_out).isEmpty()
    assert {r["score"] for r in toxicity.score(docs, labels.limit(0), held_out).collect()} == {0.0}


def test_toxic_terms_of_few_labels_and_without_a_cap(spark):
    """Five toxic labels of 25 teach, also in a rarer language, and no term is cut off."""
    letters = "abcdefghijklmnopqrst"
    many = [f"{a}{b}q" for a in letters for b in letters]
    rows = [(i, f"some{i} text{i} of{i} it", "en", None, None) for i in range(20)]
    rows += [(100 + i, f"réeuxvi other{i} " + " ".join(many), "fr", None, None) for i in range(5)]
    rows += [(200, "voilà réeuxvi", "fr", None, None), (201, "plus ttq", "fr", None, None), (202, "it is fine", "en", None, None)]
    labels = spark.createDataFrame([(r[0], int(r[0] >= 100)) for r in rows[:25]], "doc_id bigint, toxic int")
    scored = toxicity.score(fixtures.frame(spark, rows), labels, F.col("doc_id") >= 200)
    found = {r["doc_id"]: r["predicted"] for r in scored.collect()}
    assert [found[200], found[201], found[202]] == [1, 1, 0]
    examples = fixtures.frame(spark, rows[:25]).join(labels, "doc_id")
    assert set(many) <= set(toxicity._pick_terms(examples))


def test_block_max_search_is_exact():
    draw = np.random.default_rng(4)
    vectors = []
    for _ in range(700):
        terms = draw.choice(30, draw.integers(1, 6), replace=False).tolist()
        vectors.append(toxicity.unit_vector(terms, draw.integers(1, 4, len(terms)).tolist(), np.ones(30)))
    index = toxicity.BlockMaxIndex.build(vectors, list(range(700)), [0] * 700)
    for vector in vectors[:80]:
        cosines = [sum(w * v.get(t, 0.0) for t, w in vector.items()) for v in vectors]
        best = sorted((-c, i) for i, c in enumerate(cosines) if c > 0)[:7]
        found = index.nearest(vector, 7)
        assert [s for s, _ in found] == pytest.approx([-c for c, _ in best])


def test_licences(spark, docs, none):
    path = F.concat_ws("/", F.lit("repo"), F.col("lang"), F.col("doc_id").cast("string"))
    found = {r["doc_id"]: r for r in licences.scan(docs, path).collect()}
    own = [i for i, r in found.items() if r["own_licence"]]
    assert [found[i]["own_licence"] for i in own] == ["Apache-2.0"] and found[own[0]]["licence_file"]
    directory = found[own[0]]["path"].rpartition("/")[0]
    for i, r in found.items():
        inherits = r["path"].startswith(f"{directory}/") and i not in own
        assert r["licence"] == ("Apache-2.0" if inherits or i in own else None)
        assert r["declared_in"] == (directory if inherits else None)
    assert licences.scan(none, path).isEmpty()


def test_nearest_ancestor_declares(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/LICENSE", "Licensed under CC BY-NC 4.0."),
             ("a/b/c/x", "plain words"), ("a/d/y", "plain words"), ("e/z", None), ("top", "")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id bigint, path string, text string")
    found = {r["path"]: (r["licence"], r["declared_in"]) for r in licences.scan(df, F.col("path")).collect()}
    assert found["a/b/c/x"] == ("CC-BY-NC-4.0", "a/b") and found["a/d/y"] == ("MIT", "a")
    assert found["e/z"] == found["top"] == (None, None)


def test_pieces_are_those_of_the_library(docs, rows, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(PIECE_MODEL))
    encoded = pieces.encode(docs, tokenizer_file(PIECE_MODEL))
    found = {r["doc_id"]: r["pieces"] for r in encoded.collect()}
    assert found == {r[0]: model.encode(r[1] or "") for r in rows}
    decoded = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, tokenizer_file(PIECE_MODEL)).collect()}
    assert decoded == {r[0]: r[1] or "" for r in rows}
    assert pieces.encode(none, tokenizer_file(PIECE_MODEL)).isEmpty()


def test_best_sums_against_all_segmentations():
    codec = pieces.PieceCodec(tokenizer_file(PIECE_MODEL), "log")
    for text in ("▁thing", "▁ab日", "▁reading"):
        best = {0: 0.0}
        for end in range(1, len(text) + 1):
            sums = [best[s] + codec.score[codec.ids[text[s:end]]] for s in range(end) if text[s:end] in codec.ids]
            best[end] = max(sums) if sums else best[end - 1] + min(codec.score) - 10
        found = codec.segment(text)
        assert "".join(text[a:b] for a, b, _ in found) == text
        assert sum(codec.score[p] if p >= 0 else min(codec.score) - 10 for _, _, p in found) == pytest.approx(best[len(text)])


def test_neighbours_find_the_nearest(spark):
    draw = np.random.default_rng(1)
    vectors = draw.standard_normal((1500, 16)).astype(np.float32)
    vectors[500:900] = vectors[3]  # a crowd of equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(2000, None), (2050, [0.0] * 16), (2100, [None] + [1.0] * 15), (2150, [float("nan")] * 16), (2200, []), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>")
    found = neighbours.nearest(df.unionByName(df), F.col("vec_id") % 50 == 0).collect()
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        own = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        scores = units @ units[q]
        scores[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(scores, 12)))[:5]
        hits += len(set(best.tolist()) & {r["vec_id"] for r in own})
        assert all(abs(r["score"] - scores[r["vec_id"]]) < 1e-9 for r in own)
    assert hits >= 0.9 * 150 and {r["query_id"] for r in found} == set(range(0, 1500, 50))
    assert [r["vec_id"] for r in sorted((r for r in found if r["query_id"] == 550), key=lambda r: r["rank"])] == [3, 500, 501, 502, 503]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 50 == 0).isEmpty()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";</script></head>
<body><header><h1>Site name</h1></header><nav><ul><li><a href="/a">Home of the site</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and you have to accept all of them, as is the rule for it.</div>
<article><h1>The title</h1><p>The first  part of the text &amp; it is long enough to be of use to a reader, as it has
many words.<p>Short <b>one</b>.</p><p>The <a href="x">second</a> part&nbsp;is also long and it has to be read by all who are here.</p>
<form>Name: <input name=q></form></article><aside class=sidebar>More of the same for you to read at this site and others, by us.</aside>
<div id="comments"><p>I have read this and it is the best text that was on the web for me, or not at all.</p></div>
<footer>&copy; the site</footer></body></html>"""
TEXT = ("The title\n\nThe first part of the text & it is long enough to be of use to a reader, as it has many words.\n\n"
        "Short one.\n\nThe second part is also long and it has to be read by all who are here.")


def test_main_text(spark):
    cases = [PAGE, None, "", "<p>", PAGE[: PAGE.index("Short")], "plain", "<div><a href=x>only</a></div>", PAGE.replace("article", "div")]
    df = spark.createDataFrame([(i, "u", c, "clash") for i, c in enumerate(cases)] * 2, "page_id bigint, url string, html string, text string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(df).collect()}
    assert found[0] == (TEXT, len(TEXT)) and found[7][0] == TEXT
    assert found[1] == found[2] == found[3] == found[6] == ("", 0)
    assert found[4][0] == TEXT[: TEXT.index("\n\nShort")] and found[5][0] == "plain"
    assert html_text.extract(df.limit(0)).isEmpty()


LONG = "The text of the page is long enough to be of use to a reader, as it has many words that are in it."


@pytest.mark.parametrize("page, text", [
    (f"<div class='layout has-sidebar'><article><p>{LONG}</article></div>", LONG),
    (f"<div class='no-sidebar'><p>{LONG}</div>", LONG),
    (f"<div class='menu'><main><p>{LONG}</main></div><div class='menu'><p>{LONG} Not this.</div>", LONG),
    (f"<article><p>{LONG}</article><section id='comments'><article><p>{LONG} Not this.</article></section>", LONG),
    (f"<article><p>{LONG}</article><div class='related-posts'><p>{LONG} No.</div><aside><article>{LONG} No.</article></aside>", LONG),
    (f"<p>{LONG}<div class='site-footer'><p>{LONG} Not this.</div>", LONG),
])
def test_names_of_whole_boilerplate_only(page, text):
    assert html_text.main_text(page) == text


def test_boilerplate_inside_an_article_decides_nothing_beside_it():
    page = f"<div class='share-bar'>Share this</div><h1>Title</h1><p>Short one.<p>Another.<p>{LONG}"
    expected = f"Title\n\nShort one.\n\nAnother.\n\n{LONG}"
    assert html_text.main_text(f"<article>{page}</article>") == html_text.main_text(f"<div>{page}</div>") == expected


def test_pages_of_languages_without_known_stop_words():
    text = "Этот текст достаточно длинный, чтобы быть полезным читателю, и в нём много разных слов для проверки."
    page = f"<nav>Меню</nav><p>{text}<p>Коротко.<ul><li><a href=x>{text}</a></ul><footer>{text}</footer>"
    assert html_text.main_text(page).startswith(text) and html_text.main_text(page).count(text) == 1


MIT = """The MIT License (MIT)

Copyright (c) 2031 Ada Example and the Example Team

Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in
the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of
the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
GPL_HEADER = """/*
 * tool.c - does things
 *
 * This program is free software{}you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation{} either version {} of the License, or
 * (at your option) any later version.
 */
int main(void) {{ return many_things(of, code, that, follow, here); }}
"""


def test_whole_licence_files_and_wrapped_headers(spark):
    import textwrap
    from pathlib import Path

    folder = Path(licences.__file__).parent / "licence_texts"
    texts = {f.name.removesuffix(".txt"): f.read_text() for f in folder.iterdir()}
    files = [(f"{n}/LICENSE", "Copyright 2031 Ada Example\n\n" + textwrap.fill(t, 61)) for n, t in texts.items()]
    files += [("mit/LICENSE", MIT), ("mit/src/a", "plain words"), ("gpl/2", GPL_HEADER.format("; ", "", ";", 2))]
    files += [("gpl/3", GPL_HEADER.format(": ", "", ",", 3)), ("gpl/a3", GPL_HEADER.format(": ", "Affero ", ",", 3)), ("gpl/x", "plain")]
    files += [("code/mit.c", "\n".join(" * " + x for x in MIT.split("\n")) + "\nint x = call(y);" * 400), ("code/x", "plain")]
    df = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(files)], "doc_id bigint, path string, text string")
    found = {r["path"]: r for r in licences.scan(df, F.col("path")).collect()}
    assert len(found) == len(files)
    for name in texts:
        assert (found[f"{name}/LICENSE"]["own_licence"], found[f"{name}/LICENSE"]["licence_file"]) == (name, True)
    assert found["mit/LICENSE"]["licence_file"] and found["mit/src/a"]["licence"] == "MIT" and found["mit/src/a"]["declared_in"] == "mit"
    assert [found[f"gpl/{k}"]["own_licence"] for k in ("2", "3", "a3")] == ["GPL-2.0", "GPL-3.0", "AGPL-3.0"]
    assert found["code/mit.c"]["own_licence"] == "MIT" and not found["code/mit.c"]["licence_file"]
    assert found["code/x"]["licence"] is None
