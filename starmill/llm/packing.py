"""Packing of token pieces into sequences of bounded length.

Bounded-space best-fit: a task keeps a fixed number of open bins, found by free space
through a bitset (bit f is set while some open bin has f places free). A piece goes to
the fullest bin that holds it; when none does, a new bin opens, and if too many are open
the fullest closes. Pieces reach a task longest first, so short ones fill what long ones
leave.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.encoder import encoder, slices
from starmill.llm.workers import map_arrow
from starmill.sources.scratch import written

# A task receives pieces of about this many full sequences; longest-first best-fit then
# opens fewer than twice as many bins, so bins close early only in a far larger task.
TASK_SEQUENCES = 2048
OPEN_BINS = 8192
# Cutting holds little but words, so it may hold more of them: at most 320 MB a worker.
KEPT_WORDS = 800_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_lengths(total: int, capacity: int) -> list[int]:
    """Piece lengths of a document: the rest first, then full pieces."""
    rest = total % capacity
    return ([rest] if rest else []) + [capacity] * (total // capacity)


def _cut(path: str, spaces: str, end_id: int, capacity: int, with_tokens: bool, kept_words: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, spaces, kept_words)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for low, high in slices(pc.utf8_length(texts).fill_null(0).to_pylist()):
                out: list[tuple] = []
                coded = words.encode(texts.slice(low, high - low).to_pylist())
                for doc_id, data in zip(ids[low:high], coded):
                    data, start = data + end, 0
                    for number, length in enumerate(cut_lengths(len(data) // 4, capacity)):
                        own = data[start * 4 : (start + length) * 4]
                        row = (doc_id, number, start, length, zlib.crc32(own))
                        out.append((*row, np.frombuffer(own, "<i4")) if with_tokens else row)
                        start += length
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_tokens:
                    kinds, names = [*kinds, pa.list_(pa.int32())], [*names, "tokens"]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.record_batch(arrays, names=names)

    return run


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int,
    spaces: str = "lead",
    with_tokens: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Pieces of every document: its ids and the end id, cut only beyond ``capacity``.

    A null or empty text is one piece with the end id. Rows with equal ids are documents
    of their own. ``with_tokens`` adds the ids of each piece. ``kept_words`` bounds the words
    that a worker holds, also between its tasks (about 400 bytes each). No shuffle.
    """
    rows = docs.select(F.col(f"`{id_column}`").cast("bigint"), F.col(f"`{text_column}`").cast("string"))
    schema = PIECES + (", tokens array<int>" if with_tokens else "")
    return map_arrow(rows, _cut(tokenizer, spaces, end_id, capacity, with_tokens, kept_words), schema)


class BestFit:
    """Open bins of one task, found by their free space."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.free = 0  # bit f: some open bin has f places free
        self.open = self.opened = 0

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.free ^= 1 << free
        self.open -= 1
        return number

    @staticmethod
    def _lowest(bits: int) -> int:
        return (bits & -bits).bit_length() - 1

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fitting = self.free >> length
        if fitting:
            free = length + self._lowest(fitting)
            number = self._take(free)
        else:
            if self.open >= self.open_bins:
                self._take(self._lowest(self.free))
            free, number = self.capacity, self.opened
            self.opened += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - free


def _pack(capacity: int, open_bins: int, columns: Sequence[str]):
    at = list(columns).index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        packer = BestFit(capacity, open_bins)
        for batch in batches:
            placed = [packer.place(x) for x in batch.column(at).to_pylist()]
            yield pa.record_batch(
                [
                    *batch.columns,
                    pa.array([first + number for number, _ in placed], pa.int64()),
                    pa.array([offset for _, offset in placed], pa.int64()),
                ],
                names=[*columns, "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (needs ``doc_id``, ``piece``, ``length``).

    Every piece, of 1 to ``capacity`` tokens, is placed once; sequences have no gaps
    from offset 0. Pieces are dealt evenly by hash, the number of tasks following the
    tokens to place, and each task packs on its own, so a sequence lies in one task.
    Sequence numbers are unique, not dense.
    """
    total = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-int(total) // (capacity * TASK_SEQUENCES)))
    # Rows without an id, or of one id, differ by their content.
    content = [c for c in ("ids_crc32",) if c in pieces.columns]
    dealt = pieces.repartition(tasks, F.xxhash64("doc_id", "piece", "start", "length", *content))
    ordered = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", *content)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)
    placed = _pack(capacity, open_bins, pieces.columns)
    return map_arrow(ordered, placed, schema + ", sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int,
    spaces: str = "lead",
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Cut, store and pack all documents: one row per piece. No rows give no rows."""
    cut = cut_documents(docs, tokenizer, end_id, capacity, spaces, kept_words=kept_words)
    pieces = written(cut, "pieces")
    return pack(pieces, capacity)


def sequences(placed: DataFrame, token_column: str = "tokens") -> DataFrame:
    """Packed sequences with their ids, of placed pieces that carry their tokens.

    A group is one sequence, of at most ``capacity`` ids.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", token_column)))
    return (
        placed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.flatten(F.col(f"parts.{token_column}")).alias("tokens"),
            F.col("parts.doc_id").alias("doc_ids"),
            F.col("parts.offset").alias("offsets"),
        )
    )
