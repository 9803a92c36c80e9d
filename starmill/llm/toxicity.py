"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Terms are words and their first four, five and six letters, so that inflected forms of a
word share terms. Every term of which most labelled examples that hold it are toxic, with
confidence, is in the space, in any language and however many labels there are; document
frequencies are counted over all documents. The examples, a bounded number, are held in an inverted index: per
term a posting list in order of falling weight, cut into blocks with the greatest weight
of each block. A search takes blocks in order of their greatest possible contribution and
stops once no example outside can still reach the k-th best cosine, so it is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.workers import map_arrow, ship_package
from starmill.sources.scratch import written

# The bound of the model: training examples, and so the terms and entries of the index.
MAX_EXAMPLES = 20_000
# The lower end of the 95 % interval of a term's share of toxic examples is at least this
# (four of four are enough). It depends on the examples that hold the term, not on how
# many labels there are.
MIN_SHARE, DEVIATIONS = 0.5, 1.96
NEIGHBOURS = 15
BLOCK = 64
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)
_TRIM = "^[^\\p{L}]+|[^\\p{L}]+$"


def _word_terms(words: pa.Array) -> list[pa.Array]:
    """Term forms of distinct words: the word and its beginnings, null where too short."""
    lengths = pc.utf8_length(words)
    forms = [pc.if_else(pc.greater(lengths, 0), words, None)]
    for k in PREFIXES:
        start = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, k), "*", "")
        forms.append(pc.if_else(pc.greater(lengths, k), start, None))
    return forms


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document, word number) of every word, and the distinct words in lower case."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = pc.list_flatten(lists).dictionary_encode()
    docs = np.repeat(np.arange(len(texts)), counts)
    distinct = pc.replace_substring_regex(coded.dictionary, _TRIM, "").cast(pa.string())
    return docs, coded.indices.to_numpy(zero_copy_only=False), distinct


def _slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(batch), rows):
        yield batch.slice(low, rows)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, toxic documents, other documents), summed within each batch."""
    for whole in batches:
        for batch in _slices(whole):
            docs, codes, distinct = _split(batch.column(0))
            pairs = np.unique(docs * max(1, len(distinct)) + codes)
            docs, codes = np.divmod(pairs, max(1, len(distinct)))
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[docs]
            parts = []
            for form in _word_terms(distinct):
                coded = form.dictionary_encode()
                terms = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)[codes]
                seen = np.unique(np.stack([terms, docs, toxic])[:, terms >= 0], axis=1)
                n = len(coded.dictionary)
                ones = np.bincount(seen[0][seen[2] == 1], minlength=n)
                zeros = np.bincount(seen[0][seen[2] == 0], minlength=n)
                parts.append((coded.dictionary, ones, zeros))
            yield pa.record_batch(
                [
                    pa.concat_arrays([p[0] for p in parts]),
                    pa.array(np.concatenate([p[1] for p in parts]), pa.int64()),
                    pa.array(np.concatenate([p[2] for p in parts]), pa.int64()),
                ],
                names=["term", "toxic", "other"],
            )


def _document_terms(terms: list[str]):
    known = pa.array(terms, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole):
                texts = batch.column(1)
                docs, codes, distinct = _split(texts)
                found = []
                for form in _word_terms(distinct):
                    at = pc.index_in(form, known, skip_nulls=True).fill_null(-1)
                    at = at.to_numpy(zero_copy_only=False)[codes] if len(codes) else np.empty(0, np.int64)
                    found.append(docs[at >= 0] * len(terms) + at[at >= 0])
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                docs, at = np.divmod(keys, max(1, len(terms)))
                edges = np.searchsorted(docs, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column(0),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(at, pa.int32())),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(counts, pa.int32())),
                    ],
                    names=["doc_id", "terms", "counts"],
                )

    return run


@dataclass
class BlockMaxIndex:
    """Unit vectors of examples by term, in blocks of falling weight.

    ``postings[t]`` is (examples, weights); block b of a term covers its places from
    ``b * BLOCK`` on, and its first weight is its greatest.
    """

    postings: dict[int, tuple[np.ndarray, np.ndarray]]
    vectors: list[dict[int, float]]
    ids: np.ndarray
    labels: np.ndarray

    @classmethod
    def build(cls, vectors: list[dict[int, float]], ids: list[int], labels: list[int]) -> BlockMaxIndex:
        entries: dict[int, list[tuple[float, int]]] = {}
        for number, vector in enumerate(vectors):
            for term, weight in vector.items():
                entries.setdefault(term, []).append((-weight, number))
        postings = {}
        for term, own in entries.items():
            own.sort()
            postings[term] = (np.array([n for _, n in own]), np.array([-w for w, _ in own]))
        return cls(postings, vectors, np.array(ids, np.int64), np.array(labels, np.int64))

    def nearest(self, vector: dict[int, float], k: int, without: int | None = None) -> list[tuple[float, int]]:
        """The k examples of greatest positive cosine, ties to the smaller id."""
        lists = [(w, *self.postings[t]) for t, w in vector.items() if t in self.postings]
        scores: dict[int, float] = {}
        at = [0] * len(lists)
        kth = 0.0
        while True:
            # What an example not met yet can reach: the greatest open block of each term.
            ahead = [w * ws[i] if i < len(ws) else 0.0 for (w, _, ws), i in zip(lists, at)]
            if not lists or max(ahead) <= 0 or (len(scores) >= k and sum(ahead) < kth - 1e-12):
                break
            best = int(np.argmax(ahead))
            for number in lists[best][1][at[best] : at[best] + BLOCK].tolist():
                if number not in scores and number != without:
                    own = self.vectors[number]
                    scores[number] = sum(w * own.get(t, 0.0) for t, w in vector.items())
            at[best] += BLOCK
            if len(scores) >= k:
                kth = sorted(scores.values())[-k]
        ranked = sorted((-s, int(self.ids[n]), n) for n, s in scores.items())
        return [(-s, n) for s, _, n in ranked[:k]]

    def vote(self, vector: dict[int, float], without: int | None = None) -> tuple[float, list[int]]:
        """Share of toxic neighbours, weighted by cosine squared; -1 without neighbours."""
        near = self.nearest(vector, NEIGHBOURS, without)
        weight = sum(s * s for s, _ in near)
        if weight <= 0:
            return -1.0, []
        return sum(s * s for s, n in near if self.labels[n]) / weight, [int(self.ids[n]) for _, n in near[:3]]


def unit_vector(terms: list[int], counts: list[int], idf: np.ndarray) -> dict[int, float]:
    raw = {t: (1 + math.log(c)) * float(idf[t]) for t, c in zip(terms, counts)}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    return {t: w / norm for t, w in raw.items()} if norm else {}


def calibrated(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Step function from votes to the share of toxic examples (isotonic regression)."""
    levels, places = np.unique(votes, return_inverse=True)
    sums = np.bincount(places, labels, len(levels)).astype(float)
    sizes = np.bincount(places, minlength=len(levels)).astype(float)
    pools: list[list[float]] = []
    for level, total, size in zip(levels, sums, sizes):
        pools.append([level, total, size])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, total, size = pools.pop()
            pools[-1][1] += total
            pools[-1][2] += size
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _pick_terms(examples: DataFrame) -> list[str]:
    counted = map_arrow(
        examples.select("text", "toxic"), _term_counts, "term string, toxic bigint, other bigint"
    )
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
    totals = examples.agg(F.sum("toxic"), F.count("*")).first()
    ones, every = int(totals[0] or 0), int(totals[1])
    if not ones or ones == every:
        return []
    a, n, z = F.col("a"), F.col("a") + F.col("b"), DEVIATIONS
    share = a / n
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    least = (share + z * z / (2 * n) - spread) / (1 + z * z / n)
    tells = counted.filter((share > ones / every) & (least >= max(MIN_SHARE, ones / every)))
    # At most the terms of the examples.
    return sorted(r["term"] for r in tells.select("term").collect())


def score(
    docs: DataFrame,
    labels: DataFrame,
    held_out,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, evidence, evidence_vote.

    ``labels`` has ``doc_id`` and ``toxic``; only rows with 0 or 1 for which the column
    ``held_out`` (of ``doc_id``) is false teach. At most 20,000 of them, those of the
    smallest hash of the id, are the examples; equal texts of one label count once. A
    score is the vote of the 15 nearest examples, each weighted by its squared cosine,
    mapped to the share of toxic examples at such votes when each example is left out of
    its own neighbours. Texts with none of the terms, as empty or null ones, get the share
    among such examples. ``evidence`` lists the ids of the nearest examples. Without toxic
    or without other examples all scores are their share (0 without any). Repeated rows
    score alike.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    marked = labels.select(F.col("doc_id").cast("bigint"), F.col("toxic").cast("int"))
    marked = marked.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out)
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_EXAMPLES)
    # At most MAX_EXAMPLES ids and labels, hence the broadcast.
    examples = rows.join(F.broadcast(chosen), "doc_id")
    # Of equal texts the smallest id is the evidence, however often this is computed.
    examples = written(examples, "examples").groupBy("text", "toxic").agg(F.min("doc_id").alias("doc_id"))
    terms = _pick_terms(examples)
    vectors = map_arrow(rows, _document_terms(terms), "doc_id bigint, terms array<int>, counts array<int>")
    vectors = written(vectors, "term_vectors")

    seen = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    frequency = {r["t"]: r["n"] for r in seen.collect()}  # a row per chosen term
    total = vectors.count()
    idf = np.array([math.log((1 + total) / (1 + frequency.get(t, 0))) + 1 for t in range(len(terms))])
    known = vectors.join(F.broadcast(examples.select("doc_id", "toxic")), "doc_id")
    learnt = known.dropDuplicates(["doc_id"]).select("doc_id", "toxic", "terms", "counts").collect()
    learnt.sort(key=lambda r: r["doc_id"])
    units = [unit_vector(r["terms"], r["counts"], idf) for r in learnt]
    marks = np.array([r["toxic"] for r in learnt], np.int64)
    index = BlockMaxIndex.build(units, [r["doc_id"] for r in learnt], marks.tolist())
    cache: dict[tuple, tuple] = {}
    votes = np.array([index.vote(u, i)[0] if u else -1.0 for i, u in enumerate(units)])
    levels, shares = calibrated(votes, marks) if len(votes) else (np.array([-1.0]), np.array([0.0]))
    shared = spark.sparkContext.broadcast((index, idf, levels, shares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, idf, levels, shares = shared.value
        for batch in batches:
            lists = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            found = []
            for own, counts in lists:
                key = (*own, *counts)
                if key not in cache:
                    if len(cache) > 100_000:
                        cache.clear()
                    cache[key] = index.vote(unit_vector(own, counts, idf))
                found.append(cache[key])
            at = np.searchsorted(levels, [v for v, _ in found], "right") - 1
            scores = shares[np.maximum(at, 0)]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= THRESHOLD).astype(np.int32)),
                    pa.array([e for _, e in found], pa.list_(pa.int64())),
                    pa.array([v for v, _ in found], pa.float64()),
                ],
                names=["doc_id", "score", "predicted", "evidence", "evidence_vote"],
            )

    scored = map_arrow(
        vectors,
        run,
        "doc_id bigint, score double, predicted int, evidence array<bigint>, evidence_vote double",
    )
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", "predicted", "evidence", "evidence_vote")
