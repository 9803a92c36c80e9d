from __future__ import annotations

import hashlib
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill import functions as fn


def one(spark, values, expression, kind="string"):
    data = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_whole_number(spark):
    given_values = ["1", "1.0", " 12.7 ", "-3.9", "007", "x", "1d", "1.2.3", "", None, "1e"]
    expected = [1, 1, 12, -3, 7, None, None, None, None, None, None]
    assert one(spark, given_values, fn.whole_number) == expected


def test_code_text(spark):
    given_values = ["1", "01", "1.0", "0", "00", "M", " F ", "V01", "1D", "-1", "1.5", None]
    expected = ["1", "1", "1", "0", "0", "M", "F", "V01", "1D", "-1", "1.5", None]
    assert one(spark, given_values, fn.code_text) == expected


def test_zero_pad_never_cuts(spark):
    padded = one(spark, ["7", "12345678", "123456789", None], lambda c: fn.zero_pad(c, 8))
    assert padded == ["00000007", "12345678", "123456789", None]


def test_parse_day(spark):
    given_values = [
        "1022020", "01022020", "1022020.0", "31022020", "32012020", "1132020", "29022024",
        "29022023", "01010000", "-1", "", "x", None, "001022020", "1012020123",
    ]
    feb = date(2020, 2, 1)
    expected = [
        feb, feb, feb, None, None, None, date(2024, 2, 29), None, None, None, None, None, None,
        feb, None,
    ]
    assert one(spark, given_values, fn.parse_day) == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.dates(min_value=date(1, 1, 1)), min_size=1, max_size=40))
def test_parse_day_reads_back_any_day(spark, days):
    texts = [f"{d.day}{d.month:02d}{d.year:04d}" for d in days]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    read = [
        r[0]
        for r in df.orderBy("i")
        .select(F.date_format(fn.parse_day(F.col("x")), "yyyy-MM-dd"))
        .collect()
    ]
    assert read == [d.isoformat() for d in days]


def test_day_text_and_year(spark):
    shown = one(spark, [date(2020, 2, 1), None], fn.day_text, "date")
    assert shown == ["01-02-2020", "-1"]
    assert one(spark, shown + [None], fn.year_of_day_text) == [2020, None, None]


def test_recode(spark):
    recoded = one(spark, [1, 2, 9, None], lambda c: fn.recode(c, 2, {9: 2}), "int")
    assert recoded == [1, 2, 2, 2]


def test_equals_flag_is_never_null(spark):
    assert one(spark, [1, 2, None], lambda c: fn.equals_flag(c, 1), "int") == [True, False, False]


def test_first_code_in_chain(spark):
    df = spark.createDataFrame(
        [
            ("*R092*J189", None, None, "V01"),
            (None, None, "*X1", "V01"),
            (None, "no mark", "*X1", "V01"),
            (None, None, None, "X954"),
            (None, None, None, None),
            ("R1*J2*K3", None, None, "V01"),
        ],
        "a string, b string, c string, cause string",
    )
    chain = [F.col(c) for c in "abc"]
    found = df.select(
        fn.first_code_in_chain(chain).alias("first"),
        fn.terminal_code(chain, F.col("cause")).alias("terminal"),
    ).collect()
    assert [r.first for r in found] == ["*R092", "*X1", None, None, None, "*J2"]
    assert [r.terminal for r in found] == ["*R09", "*X1", "*V01", "*X95", None, "*J2"]


def test_compose_code(spark):
    df = spark.createDataFrame(
        [("11", "15"), ("11.0", "15.0"), ("35", "50308"), (None, "1")], "a string, b string"
    )
    codes = df.select(fn.compose_code(F.col("a"), F.col("b"), 5, 6)).collect()
    assert [r[0] for r in codes] == [110001, 110001, 355030, None]


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12345", 12345), ("1.234.567", 1234567), ("1.234 (3)", 1234), ("12,7", 12),
        ("1.234,99", 1234), (" 5 ", 5), ("nota", None), (None, None),
    ],
)
def test_locale_number(spark, text, number):
    assert one(spark, [text], lambda c: fn.locale_number(fn.strip_footnote(c))) == [number]


def test_locale_number_passes_numbers_through(spark):
    assert one(spark, [12.9, None], fn.locale_number, "double") == [12, None]
    assert one(spark, [12, None], fn.locale_number, "bigint") == [12, None]


def test_business_key_keeps_missing_parts_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "-1")], "x string, y string")
    keys = [r[0] for r in df.select(fn.business_key([F.col("x"), F.col("y")])).collect()]
    expected = [hashlib.md5(t.encode()).hexdigest()[:16] for t in ("a|-1", "-1|a", "a|-1")]
    assert keys == expected


def test_map_values(spark):
    assert one(spark, ["a", "b", None], lambda c: fn.map_values(c, {"a": "A"})) == ["A", None, None]


def test_without_character(spark):
    assert one(spark, ["A00.1", None], lambda c: fn.without_character(c, ".")) == ["A001", None]
