"""Words and word shingles of many texts at once, as 64-bit hashes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return, with A-Z in lower case. All work is on the byte buffer of an Arrow
column, in segments of about a megabyte that end between words, so memory does not grow
with the length of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
_SEGMENT = 1 << 20

_seeds = np.random.Generator(np.random.PCG64(20_240_501))
_BYTE = _seeds.integers(0, 1 << 64, 256, dtype=np.uint64)
_PLACE = _seeds.integers(0, 1 << 64, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# Capital letters hash as their small letters.
_BYTE[65:91] = _BYTE[97:123]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.full(max(count, 1), 0x9E3779B97F4A7C15, np.uint64))


_POWERS = _powers(256)


def _segment_words(part: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start places and hashes of the words of one segment; ``first`` marks text starts."""
    global _POWERS
    inside = ~_SPACE[part]
    before = np.empty(len(part), bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | first))
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    letters = np.flatnonzero(inside)
    at = np.searchsorted(letters, starts)
    lengths = np.diff(np.append(at, len(letters)))
    if lengths.max() > len(_POWERS):
        _POWERS = _powers(int(lengths.max()))
    place = np.arange(len(letters)) - np.repeat(at, lengths)
    weighted = _BYTE[part[letters]] * _POWERS[place]
    return starts, mixed(np.add.reduceat(weighted, at) + lengths.astype(np.uint64))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): text i holds the words ``hashes[offsets[i]:offsets[i + 1]]``.

    A null text is an empty one.
    """
    column = texts.cast(pa.large_string()).fill_null("")
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or edges[-1] == edges[0]:
        return np.zeros(len(column) + 1, np.int64), np.empty(0, np.uint64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    starts, hashes, low = [], [], 0
    while low < len(data):
        high = min(low + _SEGMENT, len(data))
        if high < len(data):
            cut = max(_last_space(data, low, high), edges[np.searchsorted(edges, high, "right") - 1])
            high = cut if cut > low else _next_cut(data, edges, high)
        first = np.zeros(high - low, bool)
        inner = edges[np.searchsorted(edges, low) : np.searchsorted(edges, high)]
        first[inner - low] = True
        at, words = _segment_words(data[low:high], first)
        starts.append(at + low)
        hashes.append(words)
        low = high
    return np.searchsorted(np.concatenate(starts), edges), np.concatenate(hashes)


def _last_space(data: np.ndarray, low: int, high: int) -> int:
    spaces = np.flatnonzero(_SPACE[data[max(low, high - 4096) : high]])
    return max(low, high - 4096) + int(spaces[-1]) if len(spaces) else low


def _next_cut(data: np.ndarray, edges: np.ndarray, high: int) -> int:
    """End of the word that runs over ``high``, however long it is."""
    limit = int(edges[np.searchsorted(edges, high)])
    while high < limit:
        spaces = np.flatnonzero(_SPACE[data[high : min(high + _SEGMENT, limit)]])
        if len(spaces):
            return high + int(spaces[0])
        high = min(high + _SEGMENT, limit)
    return limit


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its five-word shingles.

    A text of one to four words has one shingle, its whole word sequence; one without
    words has none.
    """
    offsets, words = hashed_words(texts)
    with np.errstate(over="ignore"):
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            own = words[low:high]
            if len(own) >= SHINGLE:
                total = own[: len(own) - SHINGLE + 1] * _PLACE[0]
                for k in range(1, SHINGLE):
                    total += own[k : len(own) - SHINGLE + 1 + k] * _PLACE[k]
                yield np.unique(mixed(total))
            elif len(own):
                yield mixed((own * _PLACE[: len(own)]).sum(keepdims=True) + np.uint64(len(own)))
            else:
                yield own
