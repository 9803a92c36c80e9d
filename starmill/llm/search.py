"""Ranked search of many items at once, sharing what the items have in common.

The items of a block are mined for term sets that several of them hold: with the terms of
each item in order of how many items hold them, the items form a prefix tree, and stretches
of it without a branch are term sets. Equal sets are one node, whatever stands above them.
For a batch of documents each set's partial score is computed once; the scores of tree
nodes are their parent's plus their set's, and an item reads its node. So an item costs what
it does not share, not its number of terms.

Documents are read once for their counts of item terms, which are stored, and never
leave their task afterwards; a task hands on its best rows per item.
"""

from __future__ import annotations

import math
import string
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.workers import map_arrow
from starmill.sources.scratch import written

# Items are searched in blocks of about this many distinct terms each, so that what tasks
# hold of the items does not grow with their number.
BLOCK_TERMS = 200_000
# Values of a batch of documents: terms, sets and nodes of the items times documents.
BATCH_VALUES = 6_000_000
BATCH_DOCS = 1024
NO_ID = np.iinfo(np.int64).max

_ASCII = [c for c in range(128) if chr(c) not in string.ascii_letters + string.digits]
# One pass over UTF-8: what is no term becomes a space, A-Z become a-z, all else stays.
_TERM_BYTES = bytes.maketrans(
    bytes(_ASCII) + string.ascii_uppercase.encode(), b" " * len(_ASCII) + string.ascii_lowercase.encode()
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text: runs of letters, digits and all that is not ASCII."""
    return text.translate(_TERM_BYTES).split() if text else []


@dataclass
class SharedSets:
    """The sharing graph of a block of items.

    Set i adds up rows ``members[starts[i]:starts[i + 1]]`` of the terms, each times its
    ``times``. Tree nodes are in levels: (first node, parents, sets). ``items`` gives each
    item's node; node 0 stands for no terms.
    """

    members: np.ndarray
    times: np.ndarray
    starts: np.ndarray
    levels: list[tuple[int, np.ndarray, np.ndarray]]
    items: np.ndarray
    nodes: int


def mine_shared_sets(items: Sequence[Sequence[int]]) -> SharedSets:
    """Sharing graph of items given as lists of term numbers, repeats included."""
    counted = [Counter(item) for item in items]
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    for number, counts in enumerate(counted):
        for symbol in counts.items():
            holders[symbol].append(number)
    # Symbols of the same items stand side by side, so they end in one set.
    order = {s: i for i, s in enumerate(sorted(holders, key=lambda s: (-len(holders[s]), holders[s], s)))}
    children: list[dict] = [{}]
    ends: list[int] = []
    for counts in counted:
        node = 0
        for symbol in sorted(counts.items(), key=order.__getitem__):
            if symbol not in children[node]:
                children[node][symbol] = len(children)
                children.append({})
            node = children[node][symbol]
        ends.append(node)
    kept = set(ends)
    sets: dict[tuple, int] = {}
    place = {0: 0}
    levels, level, nodes = [], [0], 1
    while level:
        parents, own, following = [], [], []
        for node in level:
            for symbol, child in children[node].items():
                stretch = [symbol]
                while child not in kept and len(children[child]) == 1:
                    (symbol, child), = children[child].items()
                    stretch.append(symbol)
                parents.append(place[node])
                own.append(sets.setdefault(tuple(sorted(stretch)), len(sets)))
                place[child] = nodes + len(following)
                following.append(child)
        if following:
            levels.append((nodes, np.array(parents), np.array(own)))
        nodes, level = nodes + len(following), following
    flat = [symbol for listed in sets for symbol in listed]
    return SharedSets(
        np.array([t for t, _ in flat], np.int64),
        np.array([n for _, n in flat], np.int64),
        np.cumsum([0, *map(len, sets)])[:-1].astype(np.int64),
        levels,
        np.array([place[node] for node in ends], np.int64),
        nodes,
    )


def shared_scores(graph: SharedSets, values: np.ndarray) -> np.ndarray:
    """Scores (item, document) of values (term, document)."""
    scores = np.zeros((graph.nodes, values.shape[1]), np.int64)
    if len(graph.members):
        rows = values[graph.members]
        if (graph.times != 1).any():
            rows *= graph.times[:, None]
        partial = np.add.reduceat(rows, graph.starts, axis=0)
        for first, parents, sets in graph.levels:
            scores[first : first + len(sets)] = scores[parents] + partial[sets]
    return scores[graph.items]


def _count_terms(vocabulary: dict[bytes, int]):
    """Per document (doc, n, terms, counts) of the terms in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, edges, terms, counts = [], [0], [], []
            for text in batch.column(1):
                own = terms_of(text.as_buffer().to_pybytes() if text.is_valid else None)
                totals.append(len(own))
                found = Counter(own)
                for term in found.keys() & vocabulary.keys():
                    terms.append(vocabulary[term])
                    counts.append(found[term])
                edges.append(len(terms))
            offsets = pa.array(edges, pa.int32())
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(totals, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["doc", "n", "terms", "counts"],
            )

    return run


class BestRows:
    """The best ``count`` (score, id) of each item: highest score, then smallest id."""

    def __init__(self, items: int, count: int):
        self.count = count
        self.scores = [np.zeros(0, np.int64)] * items
        self.ids = [np.zeros(0, np.int64)] * items
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (item, document) above 0 of documents with these ids."""
        able = scores >= self.least[:, None]
        for item in np.flatnonzero(able.any(axis=1)):
            own = np.concatenate([self.scores[item], scores[item][able[item]]])
            named = np.concatenate([self.ids[item], ids[able[item]]])
            best = np.lexsort((named, -own))[: self.count]
            self.scores[item], self.ids[item] = own[best], named[best]
            if len(best) == self.count:
                self.least[item] = own[best[-1]]


def _best_of_task(graph: SharedSets, weights: np.ndarray, n_docs: int, n_terms: int, count: int):
    """Best rows (item, doc, score) of a task's counted documents."""
    size = len(weights)
    most = max(1, min(BATCH_DOCS, BATCH_VALUES // (size + len(graph.members) + graph.nodes + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestRows(len(graph.items), count)
        for batch in batches:
            for low in range(0, batch.num_rows, most):
                part = batch.slice(low, most)
                ids = part.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                length = np.array(
                    [25 + (75 * n * n_docs) // n_terms for n in part.column(1).to_pylist()], np.int64
                )
                terms, counts = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                held = np.diff(part.column(2).offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), held)
                values = np.zeros((size, part.num_rows), np.int64)
                values[terms, doc] = weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 8 * length[doc]))
                best.add(shared_scores(graph, values), ids)
        rows = [len(x) for x in best.ids]
        ids = np.concatenate([np.zeros(0, np.int64), *best.ids])
        yield pa.record_batch(
            [
                pa.array(np.repeat(np.arange(len(rows)), rows), pa.int32()),
                pa.array(ids, pa.int64(), mask=ids == NO_ID),
                pa.array(np.concatenate([np.zeros(0, np.int64), *best.scores]), pa.int64()),
            ],
            names=["item", "doc", "score"],
        )

    return run


def _search_block(rows: DataFrame, items: list[tuple], count: int) -> DataFrame | None:
    """Best rows of the items (id, text) of one block; ``rows`` has doc and text."""
    spark = rows.sparkSession
    vocabulary: dict[bytes, int] = {}
    listed = [
        [vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(text.encode())] for _, text in items
    ]
    counted = written(map_arrow(rows, _count_terms(vocabulary), "doc bigint, n bigint, terms array<int>, counts array<bigint>"), "counted")
    total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"] or not vocabulary:
        return None
    n_docs, n_terms = total["docs"], total["terms"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / 1))] * len(vocabulary), np.int64)
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for row in held.collect():  # one row per term of the block
        weights[row["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))
    task = _best_of_task(mine_shared_sets(listed), weights, n_docs, n_terms, count)
    best = map_arrow(counted.filter(F.size("terms") > 0), task, "item int, doc bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select(
        "item_id", "rank", F.col("doc").alias("doc_id"), "score"
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    count: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``count`` highest-scoring documents of each item: item_id, rank, doc_id, score.

    Scores above 0 only; equal scores by ascending id, a document without an id last. Null
    texts have no terms. Repeated rows of documents are documents of their own; an item is
    an id with a text, so repeated rows are one item and an id with two texts is ranked
    for each. Nothing found, or an empty table, gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc"),
        F.col(f"`{text_column}`").cast("string").cast("binary").alias("text"),
    )
    asked = items.select(
        F.col(f"`{item_id}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("text"),
    ).distinct()
    asked = written(asked.withColumn("terms", F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))), "items")
    blocks = -(-(asked.agg(F.sum("terms")).first()[0] or 0) // BLOCK_TERMS)
    found = []
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        best = _search_block(rows, [(r["id"], r["text"]) for r in own.select("id", "text").collect()], count)
        if best is not None:
            found.append(written(best, "found") if blocks > 1 else best)
    if not found:
        return spark.range(0).selectExpr(
            "id AS item_id", "CAST(id AS INT) AS rank", "id AS doc_id", "id AS score"
        )
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result
