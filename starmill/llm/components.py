"""Connected components of a table of links, by rounds of grouping and joining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.sources.scratch import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that a linked node reaches.

    Alternating stars: every node passes its larger neighbours, then its smaller ones,
    to the smallest of them, until each component is a star around its smallest node.
    The links never grow in number and nothing is collected; a node with very many links
    is an ordinary skewed join key. Nodes of links to themselves or to null only are
    left out, as is the smallest node of a component. Rounds are about the logarithm of
    the longest path; each is written, so a lost executor costs one round at most.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col("u") > F.col("v"))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = written(large.distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = least.select("u", F.col("m").alias("v")).unionByName(moved.filter("u > v"))
        edges = written(small.distinct(), "links")
        state, before = _state(edges), state
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
