"""Registered queries and the pipeline over whole small tables."""

from __future__ import annotations

import os

import compare
import pytest

import corpus_pipeline
from starmill.llm.queries import CAPACITY, ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = compare.connect(FOLDER)
    assert compare.differences(spark, connection, QUERIES[name], ORACLES[name], FOLDER) is None


def test_entry_points_list_all():
    import __spark_entry__ as entry_points

    numbers = {n.split("_")[0] for n in entry_points.queries() if n.startswith("op")}
    assert numbers == {f"op{k}" for k in range(1, 14)} and "pipeline" in entry_points.queries()
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = QUERIES["op3_block_max"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("held_out")
    right = scored.filter("predicted = toxic").count()
    assert right >= 0.9 * scored.count()


def test_recall_of_neighbours(spark):
    import numpy as np

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()
    ids, units = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    found: dict = {}
    for r in QUERIES["op2_multiprobe"](spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        scores = units @ units[q]
        scores[q] = -9
        hits += len(found[ids[q]] & set(ids[np.lexsort((ids, -scores))[:5]].tolist()))
        total += 5
    assert hits >= 0.9 * total


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    placed = corpus_pipeline.run(spark, FOLDER).collect()
    kept = {r["doc_id"] for r in placed}
    passing = {r["doc_id"] for r in QUERIES["op9_host_rules"](spark, FOLDER).filter("kept").collect()}
    assert kept and kept <= passing < {r["doc_id"] for r in docs.collect()}
    stage = docs
    for name, function in corpus_pipeline.STAGES[:3]:
        left = function(spark, stage, FOLDER)
        assert left.columns == docs.columns and left.count() <= stage.count()
        stage = left
    assert {r["doc_id"] for r in stage.collect()} == kept
    ends: dict = {}
    for r in sorted(placed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= CAPACITY


def test_pipeline_keeps_one_of_repeated_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    once = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    twice = corpus_pipeline.near_duplicates(spark, docs.unionByName(docs), FOLDER)
    assert sorted(r["doc_id"] for r in once.collect()) == sorted(r["doc_id"] for r in twice.collect())


def test_piece_codec_of_repeated_rows_and_rows_without_id(spark, tmp_path):
    """Each row comes out once, with its own figures."""
    import zlib

    texts = [(1, "one text"), (1, "one text"), (1, "another one"), (None, "no id"), (None, ""), (None, None), (2, "two")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op6_piece_codec"](spark, str(tmp_path)).collect()
    assert all(r["n_pieces"] or not r["n_chars"] for r in found)
    expected = [(i, len(t or ""), zlib.crc32((t or "").encode())) for i, t in texts]
    assert sorted(((r["doc_id"], r["n_chars"], r["text_crc32"]) for r in found), key=str) == sorted(expected, key=str)
