"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to unit length, so that the nearest by distance are those of largest
cosine. A table's hash is ten projections on normal (2-stable) directions, each cut into
steps. A query visits its own bucket and neighbouring ones, in the order of their
estimated chance of holding near vectors: the query's distances to the edges of its
steps, ranked, choose among perturbations whose order is worked out once from the
expected distances. Candidates of all tables are merged and ranked by their exact cosine.

Queries meet the index in blocks: every block of index vectors is searched through its
own part of the tables by every block of queries, so a crowded bucket is spread over all
blocks and no task holds more than one block of each.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.workers import ship_package
from starmill.sources.scratch import written

HASHES, STEP, TABLES, PROBES = 10, 2.0, 8, 640
INDEX_BLOCK, QUERY_BLOCK = 4096, 2048
_SEED = 77_003


@lru_cache(maxsize=4)
def _functions(dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, offsets and key factors of all tables for vectors of some dimension."""
    draw = np.random.Generator(np.random.PCG64([_SEED, dims]))
    directions = draw.standard_normal((TABLES, dims, HASHES))
    offsets = draw.uniform(0, STEP, (TABLES, HASHES))
    factors = draw.integers(1, 1 << 62, (TABLES, HASHES), dtype=np.int64) | 1
    return directions, offsets, factors


@lru_cache(maxsize=1)
def perturbations() -> np.ndarray:
    """Sets of edges to cross, likeliest first, as 0/1 rows over the ranked edges.

    Edge j is the j-th nearest of the 2 * HASHES edges around a query. The two edges of a
    projection have mirrored ranks, so a set never holds both. Expected squared distances
    of ranked edges are those of uniform places within the steps.
    """
    m = HASHES
    rank = np.arange(1, m + 1)
    near = rank * (rank + 1) / (4 * (m + 1) * (m + 2))
    far = (1 - (2 * m + 1 - (rank + m)) / (m + 1)
           + (2 * m + 1 - (rank + m)) * (2 * m + 2 - (rank + m)) / (4 * (m + 1) * (m + 2)))
    cost = np.concatenate([near, far])
    rows = [np.zeros(2 * m, np.int64)]
    heap: list[tuple[float, tuple[int, ...]]] = [(float(cost[0]), (0,))]
    while heap and len(rows) < PROBES:
        total, edges = heapq.heappop(heap)
        last = edges[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total + cost[last + 1], (*edges, last + 1)))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*edges[:-1], last + 1)))
        if not any(2 * m - 1 - e in edges for e in edges):
            row = np.zeros(2 * m, np.int64)
            row[list(edges)] = 1
            rows.append(row)
    return np.array(rows)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def bucket_keys(units: np.ndarray) -> np.ndarray:
    """Bucket of each vector in each table: (table, vector)."""
    directions, offsets, factors = _functions(units.shape[1])
    steps = np.floor((units @ directions + offsets[:, None]) / STEP).astype(np.int64)
    with np.errstate(over="ignore"):
        return (steps * factors[:, None]).sum(axis=2)


def probe_keys(units: np.ndarray) -> np.ndarray:
    """Buckets to visit, in order: (table, query, probe)."""
    directions, offsets, factors = _functions(units.shape[1])
    place = (units @ directions + offsets[:, None]) / STEP
    steps = np.floor(place)
    below = place - steps
    edges = np.concatenate([below, 1 - below], axis=2)
    order = np.argsort(edges, axis=2, kind="stable")
    with np.errstate(over="ignore"):
        change = np.concatenate([-factors, factors], axis=1)[:, None]
        ranked = np.take_along_axis(np.broadcast_to(change, edges.shape), order, axis=2)
        own = (steps.astype(np.int64) * factors[:, None]).sum(axis=2)
        return own[:, :, None] + ranked @ perturbations().T


def candidates(index_keys: np.ndarray, visited: np.ndarray) -> np.ndarray:
    """Which index vectors each query meets in any table: (query, vector), true or false."""
    queries, vectors = visited.shape[1], index_keys.shape[1]
    met = np.zeros(queries * vectors, bool)
    for own, keys in zip(index_keys, visited):
        order = np.argsort(own, kind="stable")
        ranked = own[order]
        low = np.searchsorted(ranked, keys.ravel())
        counts = np.searchsorted(ranked, keys.ravel(), "right") - low
        hit = np.flatnonzero(counts)
        counts = counts[hit]
        first = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) if len(hit) else low[:0]
        at = order[first + np.arange(len(first))]
        met[np.repeat(hit // keys.shape[1], counts) * vectors + at] = True
    return met.reshape(queries, vectors)


def _matrix(lists: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


_FOUND = "query_class bigint, found_class bigint, score double"


def _search(count: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if len(index) and len(queries):
            dims = len(index["vector"][0])
            vectors, asked = _matrix(index["vector"], dims), _matrix(queries["vector"], dims)
            own, wanted = _unit(vectors), _unit(asked)
            met = candidates(bucket_keys(own), probe_keys(wanted))
            classes, names = index["class"].to_numpy(), queries["class"].to_numpy()
            for q in range(len(asked)):
                at = np.flatnonzero(met[q])
                if len(at) < count:
                    # Too few to choose from: the whole block, so that no query gets fewer
                    # rows than there are.
                    at = np.arange(len(vectors))
                scores = vectors[at] @ asked[q]
                scores /= np.sqrt((vectors[at] ** 2).sum(axis=1)) * np.sqrt((asked[q] ** 2).sum())
                best = np.lexsort((classes[at], -scores))[:count]
                out[0] += [names[q]] * len(best)
                out[1] += classes[at[best]].tolist()
                out[2] += scores[best].tolist()
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table(
            [pa.array(c, k) for c, k in zip(out, kinds)], names=["query_class", "found_class", "score"]
        )

    return run


def nearest(
    vectors: DataFrame,
    is_query,
    count: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Per query its ``count`` nearest other rows: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vec_id``. The score is the cosine in double precision;
    ties go to the smaller id. Where a query meets too few vectors of a block, it is compared
    with all of that block, so fewer than ``count`` rows come back only when there are fewer. Vectors that are null, zero or hold null or non-finite components take no part,
    nor do rows without an id. Vectors of another dimension are searched among their like.
    Rows with equal vectors form one class, of which the ``count + 1`` smallest ids can
    matter; each class is searched once. Rows of one id and vector count once.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
    ).filter("vec_id IS NOT NULL AND size(vector) > 0")
    limit = F.lit(float("inf"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0)).distinct()
    classes = rows.groupBy("vector").agg(F.min("vec_id").alias("class"))
    placed = written(rows.join(classes, "vector").select("vec_id", "class"), "classes")
    classes = written(classes.withColumn("dims", F.size("vector")), "class_vectors")
    asked = placed.filter(is_query).select("class").distinct()
    queries = written(classes.join(asked, "class", "left_semi"), "query_vectors")

    blocks = max(1, -(-classes.count() // INDEX_BLOCK))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    dealt = F.pmod(F.xxhash64("class"), F.lit(blocks)).cast("int").alias("block")
    asking = F.pmod(F.xxhash64("class"), F.lit(query_blocks)).cast("int").alias("query_block")
    every = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block")
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    keys = ["dims", "block", "query_block"]
    index = classes.select("*", dealt).select("*", every).groupBy(*keys)
    sought = queries.select("*", asking).select("*", each).groupBy(*keys)
    found = index.cogroup(sought).applyInArrow(_search(count + 1), _FOUND)

    best = Window.partitionBy("query_class").orderBy(F.desc("score"), "found_class")
    found = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= count + 1)
    within = Window.partitionBy("class").orderBy("vec_id")
    first = placed.withColumn("n", F.row_number().over(within)).filter(F.col("n") <= count + 1)
    spread = found.join(first, F.col("found_class") == F.col("class")).select("query_class", "vec_id", "score")
    ranked = Window.partitionBy("query_class").orderBy(F.desc("score"), "vec_id")
    spread = spread.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= count + 1)
    lists = spread.groupBy("query_class").agg(
        F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near")
    )  # at most count + 1 entries
    askers = placed.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("class").alias("query_class"))
    own = askers.join(lists, "query_class").select(
        "query_id", F.filter("near", lambda x: x["vec_id"] != F.col("query_id")).alias("near")
    )
    return own.select("query_id", F.posexplode(F.slice("near", 1, count)).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score")
    )
