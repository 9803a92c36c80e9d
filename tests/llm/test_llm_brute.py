"""Quality, licence matching and the whole pipeline against plain Python versions."""

from __future__ import annotations

import math
import os
from collections import Counter, defaultdict
from statistics import mean, variance

import numpy as np
import pytest
import regex
from test_llm_operators import as_is, base_counts, brute_components, checksum

import corpus_pipeline
from starmill.llm import licences, quality
from starmill.llm.queries import BYTE_TOKENIZER, CAPACITY, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def labels(spark):
    return [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()]


def words_of(text):
    return regex.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- quality rules


def plain_rules(rows):
    """{doc_id: kept} by the rules of texts and hosts."""
    counts, hosts = {}, defaultdict(list)
    for i, text, _, source, _ in rows:
        n, chars, symbols, lines, _, base = base_counts(text)
        worded = [x for x in (text or "").split("\n") if words_of(x)]
        failed = base, 100 * symbols > 10 * chars, 100 * lines > 30 * len(worded)
        counts[i] = source, failed
        if source is not None:
            hosts[source].append(failed)
    rates = {h: [sum(f[k] for f in own) / len(own) for k in range(3)] for h, own in hosts.items()}
    worst = {None: 0.0}
    for h, own in hosts.items():
        shrunk = []
        for k in range(3):
            every = [r[k] for r in rates.values()]
            mu, var = mean(every), variance(every) if len(every) > 1 else 0.0
            m = max(1.0, mu * (1 - mu) / var - 1) if var > 0 else 100.0
            rate = (sum(f[k] for f in own) + m * mu) / (len(own) + m)
            shrunk.append(rate - 1.96 * math.sqrt(rate * (1 - rate) / (len(own) + m + 1)))
        worst[h] = max(shrunk)
    return {i: not f[0] and worst[h] <= 0.25 for i, (h, f) in counts.items()}


def test_host_rules_as_plain_python(spark, documents):
    found = {r["doc_id"]: r["kept"] for r in QUERIES["op9_host_rules"](spark, FOLDER).collect()}
    assert found == plain_rules(documents) and len(set(found.values())) == 2


# --- quality classifier


def plain_features(text):
    text = text or ""
    words, lines = words_of(text), [x for x in text.split("\n") if x.strip(" ")]
    n = max(1, len(words))
    shares = [
        len(set(words)) / n,
        len(regex.findall(r"[#*$%&|<>]{2,}", text)) / n,
        len(regex.findall(r"\p{Lu}{2,}", text)) / n,
        len(regex.findall(r"!{2,}", text)) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
    ]
    return [min(20, math.floor(s * 20)) for s in shares]


def plain_quality(rows, labels):
    """{doc_id: score} by bins of features, path, host and all."""
    marks = {i: q for i, q in labels if q in (0, 1)}
    bins = {i: plain_features(t) for i, t, *_ in rows}
    site = {i: (s or "", lang or "") for i, _, lang, s, _ in rows}
    taught = [i for i in site if i in marks]
    good = sum(marks[i] for i in taught)
    overall = (good + 1) / (len(taught) + 2)

    def strength(pairs):
        var = mean((r - m) ** 2 for r, m in pairs)
        return min(1000.0, max(2.0, mean(m * (1 - m) for _, m in pairs) / var - 1)) if var else 1000.0

    def shrunk(groups, above):
        pairs = {g: (sum(own) / len(own), above(g)) for g, own in groups.items()}
        m = strength(list(pairs.values()))
        return {g: (sum(own) + m * above(g)) / (len(own) + m) for g, own in groups.items()}

    by_host, by_path = defaultdict(list), defaultdict(list)
    for i in taught:
        by_host[site[i][0]].append(marks[i])
        by_path[site[i]].append(marks[i])
    hosts = shrunk(by_host, lambda h: overall)
    paths = shrunk(by_path, lambda p: hosts[p[0]])
    share, odds = good / len(taught), []
    for k in range(5):
        n, n_good = Counter(bins[i][k] for i in taught), Counter(bins[i][k] for i in taught if marks[i])
        odds.append({})
        for b in n:
            of_good = (n_good[b] + share) / (good + 1)
            of_bad = (n[b] - n_good[b] + 1 - share) / (len(taught) - good + 1)
            if of_good > 0 and of_bad > 0:
                odds[-1][b] = math.log(of_good / of_bad)
    scores = {}
    for i in site:
        rate = paths.get(site[i], hosts.get(site[i][0], overall))
        evidence = sum(own.get(b, 0.0) for own, b in zip(odds, bins[i]))
        scores[i] = 1 / (1 + math.exp(-(math.log(rate / (1 - rate)) + evidence)))
    return scores


def test_quality_as_plain_python(spark, documents, labels):
    expected = plain_quality(documents, labels)
    found = {r["doc_id"]: r for r in QUERIES["op4_site_quality"](spark, FOLDER).collect()}
    assert {i: r["score"] for i, r in found.items()} == pytest.approx(expected, abs=1e-9)
    assert all(r["kept"] == (r["score"] >= 0.5) for r in found.values())
    marks = dict(labels)
    right = [r["kept"] == bool(marks[i]) for i, r in found.items() if marks.get(i) in (0, 1)]
    assert sum(right) >= 0.9 * len(right)


def test_quality_of_ties_and_long_texts(spark):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(i, ["good text of words", "good text of words", long, "!! ## !!", "", None][i % 6], "en", "a", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    marked = [(i, int(i % 6 < 3)) for i in range(0, 60, 3)]
    found = {r["doc_id"]: r["score"] for r in quality.classify(docs, spark.createDataFrame(marked, "doc_id bigint, quality int")).collect()}
    assert found == pytest.approx(plain_quality(rows, marked), abs=1e-9)
    assert found[0] == found[1] == found[6]


# --- licences


def plain_match(sentences):
    """{sentence: (score, licence)}: the nearest template by the cosine of TF-IDF."""
    def counts(text):
        return Counter(regex.findall(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*", text.lower()))

    own = {s: counts(s) for s in sentences}
    given = [(name, counts(text)) for name, text in licences.TEMPLATES]
    every = sum(sentences.values()) + len(given)
    df = Counter()
    for s, n in sentences.items():
        for w in own[s]:
            df[w] += n
    for _, c in given:
        df.update(c.keys())
    idf = {w: math.log((1 + every) / (1 + n)) + 1 for w, n in df.items()}

    def vector(c):
        return {w: (1 + math.log(n)) * idf[w] for w, n in c.items()}

    best = {}
    for s, c in own.items():
        v = vector(c)
        norm = math.sqrt(sum(x * x for x in v.values()))
        for name, t in given:
            u = vector(t)
            dot = sum(x * u[w] for w, x in v.items() if w in u)
            if dot:
                found = dot / norm / math.sqrt(sum(x * x for x in u.values())), name
                best[s] = max(best.get(s, found), found)
    return best


def test_notices_as_plain_python(spark, documents):
    sentences = Counter({"Licensed under the Apache License, Version 2.0.": 3, "MIT licence licence LICENSE": 1})
    texts = [t for _, t, *_ in documents if t and "icen" in t]
    for t in texts:
        sentences.update(x for x in t.split("\n") if regex.search("(?i)licen[cs]e", x) and len(x) < 500)
    df = spark.createDataFrame(list(sentences.items()), "sentence string, n bigint")
    found = {r["sentence"]: r["score"] for r in licences.match_sentences(df).collect()}
    expected = plain_match(sentences)
    assert found == pytest.approx({s: score for s, (score, _) in expected.items()}, abs=1e-9)


def test_inheritance_as_plain_python(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    other = "Released under the MIT License."
    paths = ["a/b/c/x", "a/b/y", "a/LICENSE", "a/b/c/d/e/z", "q/r", "LICENSE", "a/b/c/LICENSE", "a//b/./w", "k"]
    texts = {"a/LICENSE": notice, "LICENSE": other, "a/b/c/LICENSE": other}
    rows = [(i, p, texts.get(p, "plain words of a file")) for i, p in enumerate(paths)]
    df = spark.createDataFrame(rows, "doc_id bigint, path string, text string")
    found = {r["doc_id"]: r["licence"] for r in licences.scan(df, df["path"]).collect()}

    def nearest(path):
        parts = [p for p in path.split("/")[:-1] if p]
        declared = {("a",): "Apache-2.0", (): "MIT", ("a", "b", "c"): "MIT"}
        return next(declared[tuple(parts[:k])] for k in range(len(parts), -1, -1) if tuple(parts[:k]) in declared)

    assert found == {i: nearest(p) for i, p, _ in rows}


# --- pipeline


def test_pipeline_as_plain_python(spark, documents, labels):
    ruled = plain_rules(documents)
    left = [r for r in documents if ruled[r[0]]]
    scores = plain_quality(left, labels)
    left = [r for r in left if scores[r[0]] >= 0.5]
    classes = brute_components(left)
    left = [r for r in left if classes[r[0]][1] == r[0]]
    assert 0 < len(left) < sum(ruled.values()) <= len(documents)
    encode = as_is(BYTE_TOKENIZER)
    placed = corpus_pipeline.run(spark, FOLDER).collect()
    pieces = defaultdict(list)
    for r in placed:
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == {r[0] for r in left}
    total = 0
    for doc_id, text, *_ in left:
        ids, own = [*encode(text), 0], sorted(pieces[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        assert sum(r["length"] for r in own) == len(ids) and len(own) == -(-len(ids) // CAPACITY)
        for r in own:
            assert r["ids_crc32"] == checksum(ids[r["start"] : r["start"] + r["length"]])
        total += len(ids)
    sequences = defaultdict(list)
    for r in placed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        ends = np.cumsum([0, *(n for _, n in sorted(own))])
        assert [at for at, _ in sorted(own)] == ends[:-1].tolist() and ends[-1] <= CAPACITY
    assert len(sequences) <= 1.1 * -(-total // CAPACITY) + 1
