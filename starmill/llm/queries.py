"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from starmill.llm import (
    html_text, licences, line_dedup, neardup, neighbours, oracles, packing, pieces, prefix_trie,
    quality, rules, search, tokens, toxicity,
)
from starmill.sources.scratch import scratch_folder, written

WORD_TOKENIZER, WORD_END = "word_bpe_49k.json", 2
BYTE_TOKENIZER, BYTE_END = "byte_bpe_50k.json", 0
CAPACITY = 2048
PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file on this machine; workers have the same."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark, "tokens")
    tokens.write_tokens(table(spark, folder, "documents"), path, tokenizer_file(WORD_TOKENIZER), WORD_END)
    return tokens.token_digest(spark, path)


def op2_multiprobe(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_block_max(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return toxicity.score(
        table(spark, folder, "documents"), table(spark, folder, "labels"), held_out
    )


def op4_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``."""
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return licences.scan(table(spark, folder, "documents"), path)


def op6_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and the checksum of the text that they decode to."""
    model = tokenizer_file(PIECE_MODEL)
    encoded = written(pieces.encode(table(spark, folder, "documents"), model), "pieces")
    decoded = pieces.decode(encoded, model, keep=("pieces",)).select(
        "doc_id",
        F.size("pieces").cast("bigint").alias("n_pieces"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.crc32("text").alias("text_crc32"),
        "pieces",
    )
    return tokens.checksums(decoded, "pieces").select("doc_id", "n_pieces", "ids_crc32", "n_chars", "text_crc32")


def op7_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, folder, "documents"), tokenizer_file(BYTE_TOKENIZER), BYTE_END, CAPACITY
    )


def op8_min_max(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op9_host_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op10_two_pass(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op11_line_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that other documents repeat; checksum of what stays."""
    marked = line_dedup.keep_bitmaps(table(spark, folder, "documents"), keep=("doc_id", "text"))
    text = line_dedup.kept_text(F.col("text"), F.col("kept"), F.col("n_dropped"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations that begin with up to three turns of the first of their twenty."""
    turns = prefix_trie.ordered_turns(table(spark, folder, "conversations"))
    conv = F.col("conv")
    heads = F.crc32(conv.cast("string")) % 4
    return prefix_trie.prefix_nodes(prefix_trie.with_borrowed_heads(turns, conv - conv % 20, heads, 3))


def op13_shared_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_multiprobe": op2_multiprobe,
    "op3_block_max": op3_block_max,
    "op4_site_quality": op4_site_quality,
    "op5_licence_scan": op5_licence_scan,
    "op6_piece_codec": op6_piece_codec,
    "op7_best_fit": op7_best_fit,
    "op8_min_max": op8_min_max,
    "op9_host_rules": op9_host_rules,
    "op10_two_pass": op10_two_pass,
    "op11_line_bitmaps": op11_line_bitmaps,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_shared_search": op13_shared_search,
}
ORACLES: dict[str, str] = oracles.ORACLES
