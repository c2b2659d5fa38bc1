"""Golden values of the column builders."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook import functions as fn


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "v string").select(build("v").alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("0000000000123456p", "-1234.560"),
        ("00000000001234567", "1234.567"),
        ("0000000000123456z", None),
        ("", None),
        (None, None),
        ("0000000000000000p", "0.000"),
        ("12x4500000000000p", None),
        ("123p", None),
        ("0000000000123456.", None),
        ("0000000000123456 ", None),
    ],
)
def test_overpunch_of_fixed_width(spark, text, expected):
    found = one(spark, text, lambda c: fn.decode_overpunch(c, 17))
    assert found == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(
    "text,expected", [("12345y", "-123.459"), ("12x45p", None), ("7", "0.007"), ("q", "-0.001"), ("", None)]
)
def test_overpunch_of_any_width(spark, text, expected):
    found = one(spark, text, fn.decode_overpunch)
    assert found == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize("text,expected", [("12345y", "123459"), ("123456", "123456"), ("p", "0"), (None, None)])
def test_overpunch_to_digits(spark, text, expected):
    assert one(spark, text, fn.overpunch_to_digits) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("0012.50-", "-12.5"), ("0012.50+", "12.5"), ("7", "7"), (None, None), ("-", None), ("1x-", None), ("", None)],
)
def test_trailing_sign(spark, text, expected):
    found = one(spark, text, fn.decode_trailing_sign)
    assert found == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(
    "text,expected", [("46000", dt.date(2025, 12, 10)), ("0", dt.date(1899, 12, 31)), ("x", None), ("", None)]
)
def test_serial_day(spark, text, expected):
    assert one(spark, text, fn.serial_day) == expected


@pytest.mark.parametrize(
    "text,expected", [("45296789", "12:34:56"), ("0", "00:00:00"), ("86399999", "23:59:59"), ("x", None)]
)
def test_clock(spark, text, expected):
    assert one(spark, text, fn.clock_from_millis) == expected


@pytest.mark.parametrize("text,expected", [("000120", "120"), ("0000", ""), ("120", "120"), (None, None)])
def test_strip_zeros(spark, text, expected):
    assert one(spark, text, fn.strip_zeros) == expected


@pytest.mark.parametrize("text,expected", [("12345678", "5678"), ("12", "12"), ("", "")])
def test_tail(spark, text, expected):
    assert one(spark, text, lambda c: fn.tail(c, 4)) == expected


def test_file_name_parts(spark):
    names = ["GLIFCOR_01012026_A_001", "GLIFCOR_01012026_B", "GLIFCOR_0101_B_1"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    from daybook.functions.text import STRICT_FILE_PATTERN

    loose = [r[0] for r in df.select(fn.file_name_part("n", "stream")).collect()]
    strict = [r[0] for r in df.select(fn.file_name_part("n", "stream", STRICT_FILE_PATTERN)).collect()]
    assert loose == ["A", "B", None]
    assert strict == ["A", None, None]
    assert one(spark, "hdfs://h:1/in/a/X_01012026_A.gz", fn.bare_file_name) == "X_01012026_A"


def test_effective_amount_takes_local_when_currency_is_unknown(spark):
    rows = [("USD", "1", "2"), ("INR", "1", "2"), (None, "1", "2")]
    df = spark.createDataFrame(rows, "c string, f string, l string")
    assert [r[0] for r in df.select(fn.effective_amount("c", "f", "l")).collect()] == ["1", "2", "2"]


def test_null_amount_counts_as_zero_on_both_sides(spark):
    df = spark.createDataFrame([(None,), (Decimal("5"),), (Decimal("-3"),)], "a decimal(25,4)")
    rows = df.select(fn.positive_part("a"), fn.negative_part("a")).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (5, 0), (0, -3)]


def test_glcc_with_a_missing_part_is_null(spark):
    df = spark.createDataFrame([("00001", None, "1234567890")], "BRANCH_CODE string, CURRENCY string, CGL string")
    assert df.select(fn.compose_glcc()).first()[0] is None


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(10**16), 10**16), min_size=1, max_size=50))
def test_encoded_amounts_decode_to_themselves(spark, amounts):
    def encode(units):
        digits = str(abs(units)).rjust(17, "0")
        return digits[:16] + (chr(ord("p") + int(digits[16])) if units < 0 else digits[16])

    df = spark.createDataFrame([(encode(a), Decimal(a).scaleb(-3)) for a in amounts], "t string, a decimal(25,3)")
    same = fn.decode_overpunch("t", 17) == F.col("a")
    assert df.filter(~same | same.isNull()).isEmpty()


def test_business_dates():
    assert fn.is_month_end(dt.date(2024, 2, 29)) and not fn.is_month_end(dt.date(2024, 2, 28))
    assert fn.is_year_end(dt.date(2024, 3, 31)) and fn.is_financial_year_start(dt.date(2024, 4, 1))
