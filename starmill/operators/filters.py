"""A filter of key hashes that keeps a large stored table out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits a key, so that few other keys pass; and the most bits of a filter. A filter is at
# most 2 ** 27 / 64 rows of two numbers, so it can be broadcast whatever the keys' number.
BITS_PER_KEY, MAX_BITS = 16, 27
_WORD, _BITS = "__word", "__bits"


def _places(key: Column, bits: int) -> tuple[Column, Column]:
    """Word and bit of a key's hash, in 2 ** bits places of 64 a word."""
    place = F.xxhash64(key).bitwiseAND((1 << bits) - 1)
    return F.shiftright(place, 6), place.bitwiseAND(63).cast("int")


def filter_bits(keys: int) -> int:
    """Size of a filter for a number of keys, as a power of two."""
    return min(MAX_BITS, max(6, (max(keys, 1) * BITS_PER_KEY - 1).bit_length()))


def key_filter(df: DataFrame, key: str, bits: int) -> DataFrame:
    """Words of 64 places that hold a key's hash: one row per word that is not empty."""
    word, bit = _places(F.col(key), bits)
    held = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    return df.select(word.alias(_WORD), held.alias(_BITS)).groupBy(_WORD).agg(F.bit_or(_BITS).alias(_BITS))


def may_be_in(df: DataFrame, key: str, words: DataFrame, bits: int) -> DataFrame:
    """Rows whose key passes a filter: all whose key was put in, and few others.

    The filter's size is bounded, hence the broadcast; ``df`` is not shuffled.
    """
    word, bit = _places(F.col(key), bits)
    listed = F.broadcast(words.select(F.col(_WORD).alias("__filter_word"), _BITS))
    passing = df.join(listed, word == F.col("__filter_word"))
    chosen = F.call_function("shiftright", F.col(_BITS), bit).bitwiseAND(1) == 1
    return passing.filter(chosen).select(*df.columns)
