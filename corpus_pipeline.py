"""Corpus pipeline: quality rules, quality classifier, near-duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage before
it kept. ``run`` writes each stage's result to the shared folder and reads it back, so a
lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import neardup, packing, quality, rules
from starmill.llm.ids import join_ids
from starmill.llm.queries import BYTE_END, BYTE_TOKENIZER, CAPACITY, table, tokenizer_file
from starmill.operators.numbering import number_rows
from starmill.sources.scratch import written


ROW = ["__row_a", "__row_b"]
# Workers live on from stage to stage, and so do the words that packing keeps; beside the joins
# of the other stages they have room for 80 MB a worker. Words beyond are encoded again.
KEPT_WORDS = 200_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules of texts and hosts, with all their columns.

    Rows without an id, and rows that share one, are judged each on its own.
    """
    rows = _with_row(docs)
    return _kept(rows, rules.judge(rows, keep=tuple(ROW)), ROW).drop(*ROW)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is at least one half, with all their columns.

    Rows without an id, and rows that share one, are judged each on its own.
    """
    rows = _with_row(docs)
    judged = quality.classify(rows, table(spark, sf_dir, "labels"), keep=tuple(ROW))
    return _kept(rows, judged, ROW).drop(*ROW)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Where rows share an id or have none, they are numbered in the order of their ids, those
    without one last, and the row of the smallest number stays.
    """
    ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if ids[0] == ids[1]:
        return _kept(docs, neardup.near_duplicates(docs), ["doc_id"])
    rows = _with_row(docs).withColumn("__none", F.col("doc_id").isNull())
    numbered = written(number_rows(rows, ["__none", "doc_id", *ROW], "__number"), "numbered")
    judged = neardup.near_duplicates(numbered, id_column="__number").withColumnRenamed("doc_id", "__number")
    return _kept(numbered, judged, ["__number"]).drop("__none", "__number", *ROW)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their place in a sequence."""
    return packing.pack_documents(
        docs, tokenizer_file(BYTE_TOKENIZER), BYTE_END, CAPACITY, kept_words=KEPT_WORDS
    )


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicates),
    ("best-fit packing", best_fit_packing),
]


def _with_row(docs: DataFrame) -> DataFrame:
    """Documents with a 128-bit key of all that a judgement reads; equal rows share it."""
    read = [F.col(c).cast("string") for c in ("doc_id", "text", "source", "lang")]
    parts = [x for c in read for x in (c.isNull(), c)]
    keys = [F.xxhash64(*parts).alias(ROW[0]), F.xxhash64(F.lit(7), *parts).alias(ROW[1])]
    return docs.select("*", *keys)


def _kept(docs: DataFrame, judged: DataFrame, key: list[str]) -> DataFrame:
    """The documents that a stage rejects, by key, leave; all others stay."""
    rejected = written(judged.filter(~F.col("kept")).select(*key).distinct(), "rejected")
    return join_ids(docs, rejected, key, "left_anti").select(*docs.columns)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


# Best-fit packing has a state that SQL cannot express.
ORACLE_SQL = None
