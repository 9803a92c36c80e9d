"""Missing values, numbers and flags as native column expressions.

Every function takes and returns a ``Column``, so Spark keeps the work inside
whole-stage code generation and can push predicates through it. Casts of source
text are ``try_`` casts: ANSI mode is on by default and source files are dirty.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the warehouse model.
UNKNOWN_KEY = -1
UNKNOWN_LABEL = "Não Informado"
UNKNOWN_STAMP = datetime(1970, 11, 28, 0, 0)
LOAD_ZONE = timezone(timedelta(hours=-3))

_BLANKS = " \t\r\n\u00a0"
# Integer part of a plain decimal number, blanks around it allowed.
_DECIMAL = r"^\s*([+-]?\d+)\.\d*\s*$"


def trimmed(column: Column) -> Column:
    """Text without surrounding blanks. (Readers turn empty fields into nulls.)"""
    return F.btrim(column.cast("string"), F.lit(_BLANKS))


def matched(column: Column, pattern: str) -> Column:
    """First group of a pattern, null where it does not match.

    Null goes through a ``try_`` cast freely; unparsable text would cost it an exception
    per row.
    """
    found = F.regexp_extract_all(column.cast("string"), F.lit(pattern), F.lit(1))
    return F.get(found, F.lit(0))


def missing_as(column: Column, default) -> Column:
    """Replace a missing value by a stated default."""
    return F.coalesce(column, F.lit(default))


def known(column: Column, sentinel: str = str(UNKNOWN_KEY)) -> Column:
    """Predicate: present and not the text sentinel."""
    return column.isNotNull() & (column != F.lit(sentinel))


def recode(column: Column, missing, changes: Mapping | None = None) -> Column:
    """Fill a missing code with the domain default, then replace listed codes."""
    filled = F.coalesce(column, F.lit(missing))
    result = filled
    for old, new in (changes or {}).items():
        result = F.when(filled == F.lit(old), F.lit(new)).otherwise(result)
    return result


def equals_flag(column: Column, value) -> Column:
    """Boolean equality that is false, never null, for a missing value."""
    return F.coalesce(column == F.lit(value), F.lit(False))


def whole_number(column: Column) -> Column:
    """Integer part of numeric text (``'1.0'`` and ``'1'`` both give 1), else null.

    Only text with a point meets the pattern, and not even that where the point and a zero
    follow an integer in its shortest form; plain integers are cast straight away.
    """
    text = column.cast("string")
    head = integer_before_zero(text)
    slow = F.when(text.contains("."), matched(text, _DECIMAL)).otherwise(text).try_cast("bigint")
    return F.coalesce(head.try_cast("bigint"), slow)


def integer_before_zero(text: Column) -> Column:
    """``'1'`` out of ``'1.0'``; null unless the text is an integer as Spark would print it,
    and ``.0``. Blanks turn integer columns of source files into this form."""
    head = F.substring(text, F.lit(1), F.length(text) - 2)
    printed = head.try_cast("bigint").cast("string")
    return F.when(text.endswith(".0"), F.when(printed == head, head))


def zero_pad(column: Column, width: int) -> Column:
    """Left-pad with zeros; text already at or over the width stays whole."""
    text = column.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def strip_footnote(column: Column) -> Column:
    """Drop a trailing ``(n)`` mark and the blanks around what is left."""
    return trimmed(F.substring_index(column.cast("string"), "(", 1))


def locale_number(column: Column) -> Column:
    """``1.234,56`` to 1234. Numeric columns pass through; both cut to an integer."""
    text = F.replace(trimmed(column), F.lit("."), F.lit(""))
    from_text = whole_number(F.replace(text, F.lit(","), F.lit(".")))
    # typeof() of a column is a constant, so the optimizer keeps one branch only.
    is_text = F.typeof(column) == F.lit("string")
    return F.when(is_text, from_text).otherwise(column.try_cast("double").try_cast("bigint"))


def constant(value) -> Column:
    """Literal of a value; a stamp goes as text, so its wall clock holds in any zone."""
    return F.lit(str(value) if isinstance(value, datetime) else value)


def stamp_now() -> datetime:
    """Load stamp: minute precision, UTC-3 wall clock. Taken once per run."""
    return datetime.now(LOAD_ZONE).replace(tzinfo=None, second=0, microsecond=0)
