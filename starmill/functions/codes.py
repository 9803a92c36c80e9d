"""Codes and business keys as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.values import (
    UNKNOWN_KEY,
    integer_before_zero,
    trimmed,
    whole_number,
    zero_pad,
)

# Text that may not be canonical yet; most codes are, and skip the rest.
_UNCLEAN = r"^[0+]|[.\s\u00a0]"
# An integer with leading zeros, or a decimal that only repeats an integer.
_INTEGER = r"^\+?(-?)0*(\d+?)(?:\.0*)?$"


def code_text(column: Column) -> Column:
    """One canonical text per code: ``1``, ``01`` and ``1.0`` all give ``'1'``.

    Source files mix digits and letters in one column, and a blank turns an
    integer column into decimals; both sides of a lookup go through this.
    """
    text = column.cast("string")
    cleaned = F.regexp_replace(trimmed(text), _INTEGER, "$1$2")
    unclean = F.coalesce(integer_before_zero(text), cleaned)
    return F.when(text.rlike(_UNCLEAN), unclean).otherwise(text)


def code_prefix(column: Column, length: int) -> Column:
    """Leading characters of a code."""
    return F.substring(column.cast("string"), 1, length)


def compose_code(parent: Column, child: Column, child_width: int, length: int) -> Column:
    """Parent code followed by the zero-padded child code, cut to a length."""
    joined = F.concat(
        whole_number(parent).cast("string"), zero_pad(whole_number(child), child_width)
    )
    return code_prefix(joined, length).try_cast("bigint")


def without_character(column: Column, character: str) -> Column:
    """Remove a literal character."""
    return F.replace(column, F.lit(character), F.lit(""))


def first_code_in_chain(columns: Sequence[Column], mark: str = "*") -> Column:
    """First marked code of the first present column: ``*R092*J18`` gives ``*R092``.

    Text without a mark gives null, so a caller's fallback applies.
    """
    chain = F.coalesce(*columns)
    second = F.substring_index(F.substring_index(chain, mark, 2), mark, -1)
    return F.when(chain.contains(mark), F.concat(F.lit(mark), second))


def terminal_code(
    columns: Sequence[Column], fallback: Column, length: int = 4, mark: str = "*"
) -> Column:
    """Chain code, or the marked fallback code where there is none, cut to a length."""
    marked = F.concat(F.lit(mark), fallback)
    return code_prefix(F.coalesce(first_code_in_chain(columns, mark), marked), length)


def composite_code(*parts: Column) -> Column:
    """Natural key out of several codes; null when any part is missing."""
    return F.concat(*[p.cast("string") for p in parts])


def business_key(columns: Sequence[Column], length: int = 16) -> Column:
    """Hash key of several attributes.

    ``concat_ws`` skips nulls, which would let two different attribute lists share
    a key, so a missing attribute takes part as the unknown code.
    """
    parts = [F.coalesce(c.cast("string"), F.lit(str(UNKNOWN_KEY))) for c in columns]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, length)


def map_values(column: Column, values: Mapping[str, str]) -> Column:
    """Look a value up in a short fixed mapping; unmapped gives null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])
    return F.try_element_at(table, column)
