"""Column expressions: cleaning, codes, dates, numbers and business keys."""

from starmill.functions.codes import (
    business_key,
    code_prefix,
    code_text,
    compose_code,
    composite_code,
    first_code_in_chain,
    map_values,
    terminal_code,
    without_character,
)
from starmill.functions.dates import day_parts, day_text, parse_day, year_of_day_text
from starmill.functions.values import (
    equals_flag,
    known,
    locale_number,
    missing_as,
    recode,
    stamp_now,
    strip_footnote,
    whole_number,
    zero_pad,
)

__all__ = [
    "business_key",
    "code_prefix",
    "code_text",
    "compose_code",
    "composite_code",
    "day_parts",
    "day_text",
    "equals_flag",
    "first_code_in_chain",
    "known",
    "locale_number",
    "map_values",
    "missing_as",
    "parse_day",
    "recode",
    "stamp_now",
    "strip_footnote",
    "terminal_code",
    "whole_number",
    "without_character",
    "year_of_day_text",
    "zero_pad",
]
