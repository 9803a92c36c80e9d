"""Lines that many documents hold, dropped from all but one of them; column expressions only.

A line's key is the line without white space at both ends, with A-Z lower-cased, and is
known by 128 bits of hash. Hashes are dealt to tasks by ranges and sorted by hash, document
and place, so a task streams over each key: the first row is the occurrence that stays, and
the documents are counted as they pass. What comes back is one bitmap of kept lines per
document, compressed to runs; texts are not shuffled to find it.

A key that holds a large share of all lines would fill one range. Such keys, found by one
pass of bounded sketches, are counted by partial aggregation and joined back by broadcast.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.rules import bind
from starmill.operators.lookups import heavy_shares
from starmill.sources.scratch import written

MIN_CHARS = 40
MIN_DOCS = 5
SPACES = " \t\n\x0b\f\r"


def lines_of(text: Column) -> Column:
    """Lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; plain ``lower`` where all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    named = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(named)


def _text_key(text: Column) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.lit(3), F.coalesce(text, F.lit("")))


def keyed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(a, b, doc, copy, line): hash of the key and place of every line that is long enough.

    ``rows`` has ``doc``, ``copy`` and ``text``.
    """
    lines = rows.select("doc", "copy", F.posexplode(lines_of(F.col("text"))).alias("line", "text"))
    long = lines.withColumn("text", stripped(F.col("text"))).filter(F.char_length("text") >= min_chars)
    key = ascii_lower(F.col("text"))
    return long.select(
        F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7), key).alias("b"), "doc", "copy", "line"
    )


def _dropped_in_ranges(lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines to drop of keys that fit a task: streamed in order of key, document and place."""
    order = [F.col("doc").desc_nulls_last(), F.col("copy"), F.col("line")]
    ranges = lines.repartitionByRange("a", "b").sortWithinPartitions("a", "b", *order)
    group = Window.partitionBy("a", "b")
    stream = group.orderBy(*order)
    same = F.lag("doc").over(stream).eqNullSafe(F.col("doc")) & F.lag("copy").over(stream).eqNullSafe(F.col("copy"))
    found = ranges.select(
        "*", F.first("doc").over(stream).alias("last"), (~same).cast("int").alias("new")
    ).withColumn("docs", F.sum("new").over(group))
    return _losing(found, min_docs).select("doc", "copy", "line")


def _dropped_of_heavy(lines: DataFrame, min_docs: int) -> DataFrame:
    """Lines to drop of a few keys with very many lines each."""
    holders = lines.select("a", "b", "doc", "copy").distinct().groupBy("a", "b")
    counts = holders.agg(F.count("*").alias("docs"), F.max("doc").alias("last"))
    # One row per heavy key, of which there are at most two per shuffle partition.
    found = lines.join(F.broadcast(counts), ["a", "b"])
    return _losing(found, min_docs).select("doc", "copy", "line")


def _losing(found: DataFrame, min_docs: int) -> DataFrame:
    return found.filter((F.col("docs") >= min_docs) & ~F.col("doc").eqNullSafe(F.col("last")))


def dropped_lines(rows: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, copy, dropped): places of the lines to drop, ascending, of documents that have any."""
    lines = written(keyed_lines(rows, min_chars), "lines")
    heavy = list(heavy_shares(lines, ["a"])["a"])
    if not heavy:
        dropped = _dropped_in_ranges(lines, min_docs)
    else:
        listed = F.broadcast(lines.sparkSession.createDataFrame([(a,) for a in heavy], "a bigint"))
        dropped = _dropped_in_ranges(lines.join(listed, "a", "left_anti"), min_docs).unionByName(
            _dropped_of_heavy(lines.join(listed, "a", "left_semi"), min_docs)
        )
    return dropped.groupBy("doc", "copy").agg(F.sort_array(F.collect_set("line")).alias("dropped"))


def _kept_runs(dropped: Column, n_lines: Column) -> Column:
    """Runs (first, n) of kept lines between the dropped ones."""
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))

    def runs(e: Column) -> Column:
        between = F.transform(
            F.sequence(F.lit(1), F.size(e) - 1),
            lambda i: F.struct(
                (F.get(e, i - 1) + 1).alias("first"), (F.get(e, i) - F.get(e, i - 1) - 1).alias("n")
            ),
        )
        return F.filter(between, lambda run: run["n"] > 0)

    return bind(edges, runs)


def keep_bitmaps(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of every document with n_lines, n_dropped and ``kept``.

    ``kept`` is the bitmap of kept lines as runs (first, n), in order. A key of at least
    ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines
    but those of the largest id that holds it. A null text is an empty one: one empty line.
    A document is an id with a text: repeated rows are one document and are treated alike,
    rows of one id with different texts are several, and if that id is the largest, they
    all keep the line. A null id is smaller than any other. No rows give no rows.
    """
    text = F.col(f"`{text_column}`").cast("string")
    doc = F.col(f"`{id_column}`").cast("bigint")
    rows = docs.select(doc.alias("doc"), _text_key(text).alias("copy"), text.alias("text"))
    dropped = written(dropped_lines(rows, min_chars, min_docs), "dropped").select(
        F.col("doc").alias("__doc"), F.col("copy").alias("__copy"), "dropped"
    )
    wanted = docs.select(
        *[F.col(f"`{c}`").alias(f"__keep_{i}") for i, c in enumerate(keep)],
        doc.alias("doc"),
        _text_key(text).alias("copy"),
        F.size(lines_of(text)).alias("n_lines"),
    )
    same = F.col("doc").eqNullSafe(F.col("__doc")) & (F.col("copy") == F.col("__copy"))
    joined = wanted.join(dropped, same, "left")
    n = F.col("n_lines")
    whole = F.array(F.struct(F.lit(0).alias("first"), n.alias("n")))
    return joined.select(
        *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
        n.cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), whole).otherwise(_kept_runs(F.col("dropped"), n)).alias("kept"),
    )


def kept_text(text: Column, kept: Column, n_dropped: Column) -> Column:
    """The lines of a bitmap, joined by line feeds. Reads the lines of each run once."""
    parts = bind(
        lines_of(text),
        lambda lines: F.flatten(F.transform(kept, lambda run: F.slice(lines, run["first"] + 1, run["n"]))),
    )
    return F.when(n_dropped == 0, F.coalesce(text, F.lit(""))).otherwise(F.array_join(parts, "\n"))
