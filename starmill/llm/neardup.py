"""Near-duplicate documents by min-max hashing of word shingles.

Each permutation of the hash space gives two signature values of a set, the least and
the greatest image of its members, so half the hash evaluations give a signature of full
length. Six minima of six permutations form a band, and so do their six maxima; texts
that agree in a band meet in a bucket. With 64 bands a link at similarity 0.75 meets
with probability 1 - 4e-6, a closer one more surely still.

No bucket is expanded into its pairs. Texts with equal sets form one class. A bucket's
classes are compared with one pivot first, on full sets; its members that are not yet
connected with the pivot are then compared with those of other components. The
components are those of all links whose texts met, whatever the bucket's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.components import components
from starmill.llm.ids import join_ids
from starmill.llm.words import mixed, shingle_sets
from starmill.llm.workers import map_arrow
from starmill.sources.scratch import written

ROWS, GROUPS = 6, 32  # values in a band; groups of permutations, each giving two bands
BANDS = 2 * GROUPS
PERCENT = 75
SKETCH = 6  # words of 64 bits, one bit per signature value; two such planes
# Signature values whose two bits differ at similarity 0.75: 72 of 384 expected, with a
# deviation of 7.7, so a link goes unseen with a chance of 3e-7.
SKETCH_VALUES = 110

_seeds = np.random.Generator(np.random.PCG64(8_675_309))
_FACTOR = _seeds.integers(0, 1 << 32, ROWS * GROUPS, dtype=np.uint32) | np.uint32(1)
_SHIFT = _seeds.integers(0, 1 << 32, ROWS * GROUPS, dtype=np.uint32)
_MEMBER = _seeds.integers(0, 1 << 64, ROWS, dtype=np.uint64) | np.uint64(1)
_BLOCK = 200_000
_SIGNED = "doc_id bigint, n_shingles bigint, hash_1 bigint, hash_2 bigint, bands array<bigint>, sketch array<bigint>"


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minima and maxima of every permutation: an array of (set, 2, permutation)."""
    out = np.empty((len(sets), 2, ROWS * GROUPS), np.uint32)
    low = 0
    while low < len(sets):
        high, total = low, 0
        while high < len(sets) and (not total or total + len(sets[high]) <= _BLOCK):
            total += len(sets[high])
            high += 1
        values = (np.concatenate(sets[low:high]) >> np.uint64(32)).astype(np.uint32)
        starts = np.cumsum([0, *map(len, sets[low : high - 1])])
        image = np.empty_like(values)
        for p in range(ROWS * GROUPS):
            np.multiply(values, _FACTOR[p], out=image)
            np.add(image, _SHIFT[p], out=image)
            out[low:high, 0, p] = np.minimum.reduceat(image, starts)
            out[low:high, 1, p] = np.maximum.reduceat(image, starts)
        low = high
    return out


def _band_keys(signed: np.ndarray) -> np.ndarray:
    rows = signed.reshape(len(signed), BANDS, ROWS).astype(np.uint64)
    numbers = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed((rows * _MEMBER).sum(axis=2) + numbers)


def _sketches(signed: np.ndarray) -> np.ndarray:
    spread = (mixed(signed.reshape(len(signed), -1).astype(np.uint64)) >> np.uint64(62)).astype(np.uint8)
    planes = [np.packbits(spread >> plane & 1, axis=1).view(np.uint64) for plane in (0, 1)]
    return np.concatenate(planes, axis=1)


def _lists(values: np.ndarray) -> pa.Array:
    edges = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values.reshape(-1).view(np.int64)))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, len(whole), 1000):
            batch = whole.slice(low, 1000)
            sets = list(shingle_sets(batch.column(1)))
            full = [s for s in sets if len(s)]
            bands = np.zeros((len(sets), BANDS), np.uint64)
            sketch = np.zeros((len(sets), 2 * SKETCH), np.uint64)
            if full:
                some = np.array([len(s) > 0 for s in sets])
                signed = signatures(full)
                bands[some], sketch[some] = _band_keys(signed), _sketches(signed)
            with np.errstate(over="ignore"):
                sums = np.array(
                    [[s.sum(), mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum()] for s in sets], np.uint64
                ).reshape(-1, 2)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(np.ascontiguousarray(sums[:, 0]).view(np.int64)),
                    pa.array(np.ascontiguousarray(sums[:, 1]).view(np.int64)),
                    _lists(bands),
                    _lists(sketch),
                ],
                names=["doc_id", "n_shingles", "hash_1", "hash_2", "bands", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, len(whole), 1000):
            batch = whole.slice(low, 1000)
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1))]
            yield pa.record_batch(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "shingles"]
            )


def _may_link(a: str, b: str) -> Column:
    """Whether set sizes and sketches leave the two texts a chance of a link."""
    sizes = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    near = 100 * F.least(*sizes) >= PERCENT * F.greatest(*sizes)

    def differ(i: int) -> Column:
        return F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])

    differing = sum(
        (
            F.bit_count(differ(i).bitwiseOR(differ(i + SKETCH)))
            for i in range(SKETCH)
        ),
        F.lit(0),
    )
    return near & (differing <= SKETCH_VALUES)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those linked, by their full sets."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    joined = pairs.join(left, "a").join(right, "b")
    return joined.filter(100 * common >= PERCENT * union).select("a", "b")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when their sets of five-word shingles have a Jaccard
    similarity of 0.75 or more; ``component_id`` is the smallest id reachable over links
    and ``kept`` marks the document with that id. A text of fewer than five words has its
    word sequence as its one shingle; one without words (or null) is linked with nothing.
    Ids are unique, but a row may be repeated; repeated rows get equal results. A row
    without an id joins the component of its copies, or has none and is kept. No rows
    give no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    signed = written(map_arrow(rows, _signed, _SIGNED), "signed")
    identity = ["n_shingles", "hash_1", "hash_2"]
    worded = signed.filter("n_shingles > 0")
    classes = worded.groupBy(*identity).agg(F.min("doc_id").alias("rep"))
    slim = signed.select("doc_id", *identity)
    members = written(
        slim.join(classes, identity, "left").select(
            "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")
        ),
        "members",
    )
    first = members.filter("doc_id = rep AND n_shingles > 0").select(F.col("rep").alias("doc_id"))
    reps = written(
        signed.join(first.distinct(), "doc_id", "left_semi")
        .dropDuplicates(["doc_id"])
        .select(F.col("doc_id").alias("rep"), "n_shingles", "bands", "sketch"),
        "classes",
    )

    entries = reps.select("rep", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(entries.join(shared, "key"), "shared")
    # The pivot is the member that meets most others over all buckets: in a group of near
    # copies one of the most central, so few members stay unconnected with it.
    degrees = shared.groupBy("rep").agg(F.sum("n").alias("degree"))
    ranked = F.struct("degree", F.xxhash64("rep"), "rep")
    pivots = shared.join(degrees, "rep").groupBy("key").agg(F.max(ranked).alias("most"))
    pivots = pivots.select("key", F.col("most.rep").alias("pivot"))
    buckets = written(shared.select("key", "rep").join(pivots, "key"), "buckets")

    met = buckets.select("rep").distinct()
    texts = rows.select(F.col("doc_id").alias("rep"), "text")
    sets = map_arrow(join_ids(texts, met, "rep", "left_semi"), _sets, "rep bigint, shingles array<bigint>")
    sets = written(sets.dropDuplicates(["rep"]), "sets")
    known = reps.select("rep", "n_shingles", "sketch", "bands").join(met, "rep", "left_semi")
    known = written(known, "sketches")

    def plausible(pairs: DataFrame) -> DataFrame:
        with_a = pairs.join(known.alias("x"), F.col("a") == F.col("x.rep"))
        both = with_a.join(known.alias("y"), (F.col("b") == F.col("y.rep")) & _may_link("x", "y"))
        return both.select("a", "b")

    starred = buckets.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    links = written(_confirmed(plausible(starred.distinct()), sets), "star_links")
    found = components(links)

    # Members of a bucket outside its pivot's component meet those of other components.
    labels = met.join(found, F.col("rep") == F.col("node"), "left").select(
        "rep", F.coalesce("component", "rep").alias("component")
    )
    labels = written(labels.join(known, "rep"), "labels")
    mains = labels.select(F.col("rep").alias("pivot"), F.col("component").alias("main"))
    placed = buckets.join(labels.select("rep", "component"), "rep").join(mains, "pivot")
    outside = written(placed.filter("component <> main").select("key", "rep"), "outside")
    mixed_keys = outside.select("key").distinct()
    inside = buckets.join(mixed_keys, "key", "left_semi").filter("rep <> pivot").select("key", "rep")
    left = outside.join(labels, "rep").join(sets, "rep").alias("x")
    right = inside.join(labels, "rep").join(sets, "rep").alias("y")
    # Confirmed within the join, in one of the buckets that the two share: no pair leaves
    # it but links.
    common = F.size(F.array_intersect("x.shingles", "y.shingles"))
    linked = (
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.component") != F.col("y.component"))
        & _may_link("x", "y")
        & (F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("x.key"))
        & (100 * common >= PERCENT * (F.col("x.n_shingles") + F.col("y.n_shingles") - common))
    )
    crossed = left.join(right, linked).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    crossed = written(crossed, "crossing")
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(stars.unionByName(crossed))

    return members.join(final, F.col("rep") == F.col("node"), "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "rep").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "rep"), F.col("rep").isNull()).alias("kept"),
    )
