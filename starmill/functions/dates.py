"""Day parsing and presentation. Unknown days are null until they are presented."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.values import matched

# Fixed formats of the source files and of the presented tables.
SOURCE_DAY = "ddMMyyyy"
PRESENTED_DAY = "dd-MM-yyyy"
PRESENTED_STAMP = "dd-MM-yyyy HH:mm"
PRESENTED_UNKNOWN_DAY = "-1"

# Day, month and year digits with lost or doubled leading zeros, maybe as a decimal. Days
# that no year has are left out here, where they cost nothing, so that only 29 February
# is left for the date parser to refuse.
_DAY_AND_MONTH = (
    r"(?:0?[1-9]|1\d|2[0-8])(?:0[1-9]|1[0-2])"
    r"|(?:29|30)(?:0[13-9]|1[0-2])"
    r"|31(?:0[13578]|1[02])"
    r"|2902"
)
_DAY_DIGITS = rf"^\s*0*((?:{_DAY_AND_MONTH})(?!0000)\d{{4}})(?:\.\d*)?\s*$"


def parse_day(column: Column) -> Column:
    """``1022020`` (leading zero lost) to 2020-02-01; impossible days to null.

    Seven or eight digits and nothing else are taken apart as a number; other text meets the
    pattern and the date parser, which cost some times as much.
    """
    text = column.cast("string")
    number, length = text.try_cast("int"), F.length(text)
    # So large a number leaves no room for anything but its digits.
    plain = (number >= 1_000_000) & (
        ((length == 8) & ((number >= 10_000_000) | text.startswith("0")))
        | ((length == 7) & (number < 10_000_000))
    )
    day, month, year = F.floor(number / 1_000_000), F.floor(number / 10_000) % 100, number % 10_000
    day, month = day.cast("int"), month.cast("int")
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    last = (
        F.when(month == 2, F.when(leap, 29).otherwise(28)).when(month.isin(4, 6, 9, 11), 30).otherwise(31)
    )
    exists = (year > 0) & month.between(1, 12) & (day >= 1) & (day <= last)
    digits = matched(text, _DAY_DIGITS)
    parsed = F.try_to_date(F.lpad(digits, len(SOURCE_DAY), "0"), SOURCE_DAY)
    return F.when(plain, F.when(exists, F.make_date(year, month, day))).otherwise(parsed)


def day_text(day: Column) -> Column:
    """Presented day text, with the sentinel for an unknown day."""
    return F.coalesce(F.date_format(day, PRESENTED_DAY), F.lit(PRESENTED_UNKNOWN_DAY))


def day_parts(day: Column) -> dict[str, Column]:
    """Zero-padded day, month and year text of a day."""
    return {
        "day_of_month": F.date_format(day, "dd"),
        "month": F.date_format(day, "MM"),
        "year": F.date_format(day, "yyyy"),
    }


def year_of_day_text(text: Column) -> Column:
    """Year out of presented day text (characters 7 to 10)."""
    return F.substring(text, 7, 4).try_cast("int")
