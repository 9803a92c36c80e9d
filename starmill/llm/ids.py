"""Joins of whole documents to a list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A list of at most so many ids (8 bytes each) is broadcast; with a longer one both sides
# are shuffled. The result is the same.
BROADCAST_IDS = 1_000_000


def join_ids(docs: DataFrame, ids: DataFrame, column: str | list[str], how: str) -> DataFrame:
    """Semi or anti join of ``docs`` to stored ids, by columns of the same names."""
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} would need one row per id")
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, column, how)
