"""Cases in which rows, texts or whole articles were once lost."""

from __future__ import annotations

import time

import fixtures
import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import licences, neighbours, quality, rules, toxicity
from starmill.llm.html_text import hides, main_text

PROSE = "The quick brown fox was in the garden and it is that which for on are as with the people of the town."


@pytest.mark.parametrize(
    "page",
    [
        f'<body class="overflow-hidden relative"><article><p>{PROSE}</p></article></body>',
        f'<article class="hidden md:block"><p>{PROSE}</p></article>',
        f'<article title="a hidden truth"><p>{PROSE}</p></article>',
        f'<article><p hidden>no {PROSE}</p><p style="display: none">no</p><p aria-hidden="true">no</p><p>{PROSE}</p></article>',
        f'<body><form id="aspnetForm"><nav>menu</nav><div><p>{PROSE}</p></div><footer>foot</footer></form></body>',
        f"<body><form><article><p>{PROSE}</p></article></form></body>",
        f"<article><p>{PROSE}</p><form><p>{PROSE}</p></form></article>",
        f'<article><p><a href="x">{PROSE}</a></p><ul class="share"><li><a href="y">{PROSE}</a></li></ul></article>',
        f"<div><p>{PROSE}</p></div><form><label>Your name</label><p>Send us a message and we will be in touch.</p></form>",
    ],
)
def test_articles_are_not_dropped(page):
    assert main_text(page) == PROSE


@pytest.mark.parametrize("attributes, expected", [
    (" hidden", True), (" hidden=hidden", True), (" data-hidden=1", False), (" class='hidden'", False),
    (" aria-hidden=true", True), (" aria-hidden='false'", False), (" style='color:red;DISPLAY :NONE'", True),
    (" title='display:none'", False), ("", False),
])
def test_only_attributes_hide(attributes, expected):
    assert hides(attributes) is expected


def test_stray_tags_take_little_time():
    start = time.perf_counter()
    for page in (
        "<article><p>" + "<b>" * 20_000 + PROSE + "</i>" * 20_000,
        "<article><b>" + "<div>" * 10_000 + PROSE + "</b>" * 10_000,
        "<article><p>" + "</b></div></x>" * 15_000 + PROSE,
    ):
        assert main_text(page) == PROSE
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("size", [1, 2, 6, 9])
def test_neighbours_of_small_tables_are_complete(spark, size):
    draw = np.random.default_rng(size)
    rows = [(50 * i, draw.normal(size=16).tolist()) for i in range(size)]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0)
    near: dict = {}
    for r in found.collect():
        near.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    for i in units:
        ranked = sorted((-float(units[i] @ units[j]), j) for j in units if j != i)[:5]
        listed = [j for _, j in sorted(near.get(i, []))]
        assert len(listed) == len(ranked) and len(set(listed)) == len(listed)
        if size <= 6:
            assert listed == [j for _, j in ranked]


def test_toxicity_takes_other_id_types_and_doubled_labels(spark):
    rows = fixtures.awkward_documents()
    docs = fixtures.frame(spark, rows).withColumn("doc_id", F.col("doc_id").cast("int"))
    docs = docs.unionByName(docs.limit(1).withColumn("doc_id", F.lit(None).cast("int")))
    labels = [(i, 1, int(i % 2)) for i in range(20)] + [(3, 1, 0), (4, 1, 1), (None, 1, 1)]
    labels = spark.createDataFrame(labels, "doc_id int, quality int, toxic int")
    found = toxicity.score(docs, labels, F.col("doc_id") % 4 == 2).collect()
    assert len(found) == len(rows) + 1 and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["held_out"] is not None for r in found)
    again = toxicity.score(docs, labels, F.col("doc_id") % 4 == 2).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_quality_keeps_named_columns(spark):
    docs = fixtures.frame(spark, fixtures.awkward_documents()).withColumn("__row", F.monotonically_increasing_id())
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    found = quality.classify(docs, labels, keep=("__row",))
    assert found.select("__row").distinct().count() == docs.count() == found.count()


def test_pipeline_stages_judge_rows_without_own_ids(spark):
    import corpus_pipeline

    good = [" ".join(f"w{draw}x{i}" for i in range(80)) for draw in range(6)]
    rows = [
        (1, good[0], "en", "a", 1), (1, "$ # %", "en", "a", 1), (None, "too short", "en", "a", 1),
        (None, good[1], "en", "a", 1), (2, good[2], "en", "b", 1), (3, good[2] + " more", "fr", "b", 1),
        (None, good[2], None, None, 1), (4, None, "en", "b", 1), (5, good[3], "en", "b", 1), (5, good[4], "en", "b", 1),
        (5, good[4], "en", "b", 1),
    ]
    docs = fixtures.frame(spark, rows).repartition(2)
    ruled = corpus_pipeline.quality_rules(spark, docs, "")
    texts = sorted((r["doc_id"] or 0, r["text"]) for r in ruled.collect())
    assert texts == sorted((r[0] or 0, r[1]) for r in rows if r[1] and len(r[1]) > 99)
    assert ruled.columns == docs.columns
    once = corpus_pipeline.near_duplicates(spark, ruled, "")
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in once.collect())
    assert kept == sorted([(1, good[0]), (0, good[1]), (2, good[2]), (5, good[3]), (5, good[4])])
    assert once.columns == docs.columns


def test_licence_words_are_counted(spark):
    sentences = ["b a b a c", "one", "", "Licence licence LICENCE v1.0 v1.0"]
    df = spark.createDataFrame(list(enumerate(sentences)), "key int, sentence string")
    found = sorted(tuple(r) for r in licences._term_counts(df, "key").collect())
    assert found == [
        (0, "a", 2), (0, "b", 2), (0, "c", 1), (1, "one", 1), (3, "licence", 3), (3, "v1.0", 2),
    ]


def test_very_long_licence_line_takes_little_time(spark):
    words = " ".join(f"word{i}" for i in range(30_000))
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, words + " released under some licence " + words), (2, notice), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    start = time.perf_counter()
    found = {r["doc_id"]: r for r in licences.scan(docs, F.concat(F.lit("a/"), F.col("doc_id").cast("string"))).collect()}
    assert time.perf_counter() - start < 60
    assert found[2]["own_licence"] == "Apache-2.0" and found[1]["own_licence"] is None
    assert found[3]["licence"] == "Apache-2.0"


def test_verdicts_come_from_hosts(spark):
    good, loud = "a b c d e f g h i j k", "a b c d e f g h i j k ### $$$ %%%"
    rows = [(i, loud if i % 20 == 0 else good, None, f"host{i % 9}", None) for i in range(900)]
    rows += [(2000 + i, loud if i % 2 else good, None, "loud", None) for i in range(300)]
    rows += [(3000, loud, None, "new", None), (4000, loud, None, None, None)]
    judged = {r["doc_id"]: r for r in rules.judge(fixtures.frame(spark, rows)).collect()}
    # Half of a large host's documents fail the rule of symbols: all of them go.
    assert not judged[2000]["kept"] and not judged[2000]["symbols_failed"] and not judged[2000]["host_kept"]
    assert not judged[2001]["kept"] and judged[2001]["symbols_failed"] and not judged[2001]["base_failed"]
    # A host with one document is not judged by it, nor is a document of a good host.
    assert judged[3000]["symbols_failed"] and judged[3000]["kept"]
    assert judged[0]["symbols_failed"] and judged[0]["kept"] and judged[4000]["kept"]
