"""Data checks that return the violating rows, and load reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent, with their row count.

    Rows are counted per key before the join, so a key that holds a third of the rows
    crosses the network once per task.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    parents = parent.select(F.col(parent_key).alias("__parent"))
    return counts.join(parents, F.col(key) == F.col("__parent"), "left_anti")


def key_collisions(
    members: DataFrame, stored: DataFrame, key: str, attributes: Sequence[str]
) -> DataFrame:
    """Members whose key is stored for other attributes: two members under one hash key.

    Both sides are compared by a hash of the attributes that is independent of the key, so
    one number a row joins. Missing attributes agree with each other only.
    """
    parts = [x for c in attributes for x in (F.col(c).isNull(), F.col(c))]
    own = members.withColumn("__own", F.xxhash64(*parts))
    other = stored.select(F.col(key).alias("__key"), F.xxhash64(*parts).alias("__other")).distinct()
    joined = own.join(other, (F.col(key) == F.col("__key")) & (F.col("__own") != F.col("__other")), "left_semi")
    return joined.select(*members.columns)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_nulls")


def top_by_key(df: DataFrame, key: str, count: int = 5) -> DataFrame:
    """The rows of the highest keys: what a load added last."""
    return df.orderBy(F.col(key).desc()).limit(count)


def first_rows(df: DataFrame, count: int = 5) -> DataFrame:
    """Any few rows of a table, for a look at it."""
    return df.limit(count)


def load_report(loads: dict[str, DataFrame]) -> DataFrame:
    """Row count per load step."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(step).alias("step"), "n_rows")
        for step, df in loads.items()
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
