"""Surrogate keys: dense numbers at any size, and the unknown member."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions.values import UNKNOWN_KEY, constant
from starmill.session import footer_aggregates
from starmill.sources.scratch import written
from starmill.sources.tables import Tables

_FILE, _ROW, _FIRST = "__file", "__row", "__first"
_BROADCAST_FILES = 1_000_000


def last_key(df: DataFrame, key: str) -> int:
    """Highest key in use, 0 when there is none or only the unknown member."""
    return df.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(0)).cast("bigint")).first()[0]


def last_stored_key(
    tables: Tables,
    name: str,
    schema: str,
    key: str,
    by: str | None = None,
    without: DataFrame | None = None,
) -> int:
    """``last_key`` of a stored table, taken from file footers whatever its size.

    With ``by``, a partition column, the parts listed in ``without`` are left out: those
    that the running load is about to replace.
    """
    with footer_aggregates(tables.spark):
        df = tables.read(name, schema)
        if without is not None:
            parts = df.groupBy(by).agg(F.max(key).alias(key))
            df = parts.join(without.select(by).distinct(), by, "left_anti")
        return last_key(df, key)


def number_stored(stored: DataFrame, key: str, after: int = 0) -> DataFrame:
    """Number the rows of a stored Parquet table after a given key, without a shuffle.

    A row's key is the number of rows in the files before its own plus its place in
    the file. Both come from file metadata, so retried or speculative tasks give the
    same keys. A file is known by its task and its place among the task's files, as
    Spark's writer names them, in one folder or in one of several partitions. What is broadcast has two numbers per file, and only up
    to a million files.
    """
    spots = stored.select(
        "*",
        F.col("_metadata.file_name").alias(_FILE),
        F.col("_metadata.row_index").alias(_ROW),
    )
    # Names are taken apart per file, not per row.
    task = F.split_part(_FILE, F.lit("-"), F.lit(2)).cast("bigint")
    place = F.regexp_extract(_FILE, r"[-.]c(\d+)\.", 1).cast("bigint")
    before = Window.orderBy(task, place, _FILE).rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        spots.groupBy(_FILE)
        .agg(F.count("*").alias("n"))
        .select(_FILE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_FIRST))
    )
    if len(stored.inputFiles()) <= _BROADCAST_FILES:
        firsts = F.broadcast(firsts)
    return spots.join(firsts, _FILE).select(
        *stored.columns,
        (F.lit(after) + F.col(_FIRST) + F.col(_ROW) + F.lit(1)).cast("bigint").alias(key),
    )


def number_rows(df: DataFrame, order_by: Sequence[str], key: str, after: int = 0) -> DataFrame:
    """Dense keys in the order of the given columns, starting after a given key.

    The rows are range-partitioned and sorted into files, then numbered by file
    position. A plain ``row_number`` over all rows would pass them through one task.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return number_stored(written(ordered, "numbered"), key, after)


def with_unknown(df: DataFrame, key: str, row: Mapping) -> DataFrame:
    """Table with exactly one unknown member, however often it is loaded.

    Columns that ``row`` leaves out are null in the unknown member.
    """
    types = dict(df.dtypes)
    values = {key: UNKNOWN_KEY, **row}
    unknown = df.sparkSession.range(1).select(
        *[constant(values.get(c)).cast(types[c]).alias(c) for c in df.columns]
    )
    return df.filter(F.col(key) != UNKNOWN_KEY).unionByName(unknown)
