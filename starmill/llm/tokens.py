"""Token ids of documents as Parquet files, for reading chosen tokens and metadata.

One row per document in ascending order of its id, across all files: ``doc_id``,
``n_tokens``, ``first`` (ids of the documents before it in its file) and ``tokens``, a
list of ids. Ids repeat, so their pages are dictionary-encoded, and delta-encoded where
a dictionary would grow too large. Row groups and pages are small enough that their
minima and maxima (page indexes) let a reader skip what it does not need.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.encoder import encoder, slices
from starmill.llm.workers import map_arrow

SCHEMA = "doc_id bigint, n_tokens bigint, first bigint, tokens array<int>"
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
}


def _encoded(path: str, spaces: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, before = encoder(path, spaces), 0
        for batch in batches:
            texts = batch.column(1)
            for low, high in slices(pc.utf8_length(texts).fill_null(0).to_pylist()):
                ids = [x + end for x in words.encode(texts.slice(low, high - low).to_pylist())]
                counts = np.array([len(x) for x in ids], np.int64) // 4
                edges = np.concatenate([[0], np.cumsum(counts)])
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(counts),
                        pa.array(before + edges[:-1]),
                        pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), flat),
                    ],
                    names=["doc_id", "n_tokens", "first", "tokens"],
                )
                before += int(edges[-1])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    spaces: str = "drop",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every whole text and write the token files to a folder.

    A null or empty text gives the end id alone. Rows without an id come first. Rows of
    one id may stand in any number of files, ordered by a hash of the text; the order of
    equal rows does not matter. Other columns are ignored. The texts are shuffled once, in
    ranges of the id, so each task encodes and writes one sorted range, and a task that
    is run again writes the same file.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = map_arrow(ranges, _encoded(tokenizer, spaces, end_id), SCHEMA)
    encoded.write.options(**FILE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Token rows with the number of their file in the order of ids.

    Filters on ``doc_id`` skip files, row groups and pages; columns not selected are not read.
    """
    part = F.split_part(F.col("_metadata.file_name"), F.lit("-"), F.lit(2)).cast("int")
    return spark.read.schema(SCHEMA).parquet(path).select("*", part.alias("part"))


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): ids in the files before each file. Reads one column of counts; the
    running sum is over one row per file."""
    totals = read_tokens(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def checksums(rows: DataFrame, token_column: str = "tokens") -> DataFrame:
    """Replace the tokens by ``ids_crc32``, the crc32 of their little-endian 32-bit form."""
    others = [c for c in rows.columns if c != token_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(others))
            edges = lists.offsets.to_numpy().tolist()
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(edges[:-1], edges[1:])]
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(sums, pa.int64())], names=[*others, "ids_crc32"]
            )

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", ids_crc32 bigint"
    return map_arrow(rows.select(*[f"`{c}`" for c in others], token_column), run, schema)


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document its place in the id stream, its length and its checksum, read from
    the files."""
    read = checksums(read_tokens(spark, path))
    return read.join(file_starts(spark, path), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
