"""SentencePiece encoding and decoding with a piece automaton.

An Aho-Corasick automaton over all pieces reads a text once. At each place it lists, over
its output links, the pieces that end there, longest first, and the best last piece of
the text so far is chosen from them: a single-pass Viterbi. For a model of merge ranks
(BPE) the best is the one that the merges would leave, which holds for a piece exactly
when the piece and the one before it, merged on their own, stay as they are. That is
unique, so the first that fits is taken, and the ids equal those of the merging encoder.
For a model of log probabilities (unigram) the best is the largest sum of scores.

Texts are cut before spaces, which no piece but runs of spaces holds inside, and at line
feeds, which no piece holds; recent parts keep their ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.encoder import slices
from starmill.llm.workers import map_arrow

SPACE = "▁"
_PART = re.compile(rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")


class PieceCodec:
    """Encoder and decoder of one model file; ``scores`` is 'merges' or 'log'."""

    def __init__(self, path: str, scores: str = "merges", kept: int = 300_000):
        import ahocorasick
        import sentencepiece

        if scores not in ("merges", "log"):
            raise ValueError(f"scores must be 'merges' or 'log', not {scores!r}")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.log, self.kept = scores == "log", kept
        self.unknown = model.unk_id()
        self.piece = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.score = [model.get_score(i) for i in range(model.vocab_size())]
        self.length = [len(text) for text in self.piece]
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.plain: list[bytes] = []
        automaton = ahocorasick.Automaton()
        for i, text in enumerate(self.piece):
            if model.is_byte(i):
                self.bytes[int(text[3:5], 16)] = i
                self.plain.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unused(i) or model.is_unknown(i):
                self.plain.append(b"" if not model.is_unknown(i) else " ⁇ ".encode())
            else:
                self.plain.append(text.replace(SPACE, " ").encode())
                self.ids[text] = i
                automaton.add_word(text, i)
        automaton.make_automaton()
        self.automaton = automaton
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        spaced = [p for p in self.ids if SPACE in p[1:] and p.strip(SPACE)]
        if spaced or any("\n" in p for p in self.ids):
            raise ValueError(f"pieces with inner spaces or line feeds: {spaced[:3]}")
        self.fitting: dict[int, bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _merged(self, text: str) -> list[str]:
        """The merges' result for a short text: the best-scored pair first, then the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [
                (-self.score[self.ids[a + b]], k)
                for k, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in self.ids
            ]
            if not pairs:
                break
            _, k = min(pairs)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _fits(self, before: int, after: int) -> bool:
        """Whether two adjacent pieces (the first -1 at the start) stay as they are."""
        first = self.piece[before] if before >= 0 else ""
        expected = [first, self.piece[after]] if first else [self.piece[after]]
        known = self._merged(first + self.piece[after]) == expected
        if len(self.fitting) > 4 * self.kept:
            self.fitting.clear()
        self.fitting[before * len(self.piece) + after] = known
        return known

    def segment(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, id) of the pieces of one part; the id of an unknown letter is -1.

        The automaton lists the pieces that end at a place, longest first, before it moves
        on. No piece holds an unknown letter, so nothing reaches across one.
        """
        best = self._best_sums(text) if self.log else self._unmerged(text)
        out, end = [], len(text)
        while end:
            piece = best[end]
            start = end - 1 if piece < 0 else end - self.length[piece]
            out.append((start, end, piece))
            end = start
        return out[::-1]

    def _unmerged(self, text: str) -> list[int]:
        """Last piece of every beginning of the text, as the merges would leave it."""
        best = [-1] * (len(text) + 1)
        fitting, size = self.fitting, len(self.piece)
        for last, piece in self.automaton.iter(text):
            if best[last + 1] < 0:
                before = best[last + 1 - self.length[piece]]
                fits = fitting.get(before * size + piece)
                if fits or fits is None and self._fits(before, piece):
                    best[last + 1] = piece
        return best

    def _best_sums(self, text: str) -> list[int]:
        """Last piece of every beginning of the text, by the largest sum of scores."""
        best, floor = [-1] * (len(text) + 1), min(self.score) - 10.0
        total, reached = [0.0] + [-np.inf] * len(text), 0
        for last, piece in self.automaton.iter(text):
            end, start = last + 1, last + 1 - self.length[piece]
            for missed in range(reached + 1, start + 1):
                if total[missed] == -np.inf:
                    total[missed] = total[missed - 1] + floor
            reached = max(reached, start)
            if total[start] + self.score[piece] > total[end]:
                total[end], best[end] = total[start] + self.score[piece], piece
        return best

    def _encode_part(self, text: str) -> bytes:
        ids: list[int] = []
        for start, end, piece in self.segment(text):
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.bytes.get(b, self.unknown) for b in text[start:end].encode()]
        return np.array(ids, "<u4").tobytes()

    def _learn(self, keys: set[str]) -> None:
        """Ids of new parts; a part is cut once more where no piece joins two letters."""
        young, old, joined = self.young, self.old, self.joined
        for key in keys:
            ids = old.get(key)
            if ids is None:
                cuts = [k for k in range(1, len(key)) if key[k - 1 : k + 1] not in joined]
                ids = b""
                for low, high in zip([0, *cuts], [*cuts, len(key)]):
                    own = key[low:high]
                    known = young.get(own)
                    if known is None:
                        known = young[own] = self._encode_part(own)
                    ids += known
            young[key] = ids

    def _parts(self, text: str) -> list[str]:
        return _PART.findall((" " + text).replace(" ", SPACE)) if text else []

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text is an empty one."""
        parts = [self._parts(text or "") for text in texts]
        if len(self.young) > self.kept:
            self.old, self.young = self.young, {}
        self._learn(set().union(*parts) - self.young.keys())
        get = self.young.__getitem__
        return [b"".join(map(get, own)) for own in parts]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, without the space put before the first word."""
        data = b"".join(map(self.plain.__getitem__, ids.tolist()))
        return data.removeprefix(b" ").decode("utf-8", "replace")


_codecs: dict[tuple[str, str], PieceCodec] = {}


def codec(path: str, scores: str = "merges") -> PieceCodec:
    """One codec per model and worker process."""
    key = (path, scores)
    if key not in _codecs:
        _codecs[key] = PieceCodec(path, scores)
    return _codecs[key]


def encode(
    docs: DataFrame, model: str, scores: str = "merges", id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, pieces): the ids of every whole text, in a list. Row by row, no shuffle.

    Null and empty texts give an empty list; repeated rows are encoded alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, scores)
        for batch in batches:
            texts = batch.column(1)
            for low, high in slices(pc.utf8_length(texts).fill_null(0).to_pylist()):
                ids = own.encode(texts.slice(low, high - low).to_pylist())
                edges = np.cumsum([0, *map(len, ids)]) // 4
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), flat)
                yield pa.record_batch([batch.column(0).slice(low, high - low), lists], names=["doc_id", "pieces"])

    rows = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").cast("string"))
    return map_arrow(rows, run, "doc_id bigint, pieces array<int>")


def decode(encoded: DataFrame, model: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text) of (doc_id, pieces); no pieces give an empty text. Columns named in
    ``keep`` follow, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for whole in batches:
            for low in range(0, len(whole), 500):
                batch = whole.slice(low, 500)
                lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
                edges, ids = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
                texts = [own.decode(ids[a:b]) for a, b in zip(edges[:-1], edges[1:])]
                kept = [batch.column(1) if name == "pieces" else batch.column(2 + others.index(name)) for name in keep]
                yield pa.record_batch(
                    [batch.column(0), pa.array(texts, pa.string()), *kept], names=["doc_id", "text", *keep]
                )

    others = [name for name in keep if name != "pieces"]
    kinds = dict(encoded.dtypes)
    schema = "doc_id bigint, text string" + "".join(f", `{name}` {kinds[name]}" for name in keep)
    return map_arrow(encoded.select("doc_id", "pieces", *[f"`{name}`" for name in others]), run, schema)
