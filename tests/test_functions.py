"""Expressions: casts, hashes, NULL rules, dates."""

import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from awareness_mart.functions import (
    add_years,
    blank_to_null,
    date_key,
    default_if_blank,
    differs,
    first_of_month,
    iso_year,
    last_of_previous_month,
    lenient_date,
    lenient_double,
    person_key,
    row_hash_delimited,
    row_hash_plain,
    row_hash_strict,
    strict_mean,
)


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression).head()[0]


@pytest.mark.parametrize(
    "text, number",
    [
        ("12.5", 12.5),
        (" 3.1 ", 3.1),
        ("1_000", 1000.0),
        ("1__0", None),
        ("_1", None),
        ("+5", 5.0),
        (".5", 0.5),
        ("5.", 5.0),
        ("1e5", 100000.0),
        ("", None),
        (None, None),
        ("abc", None),
        ("1.0d", None),
        ("1f", None),
        ("0x1p3", None),
        ("1,5", None),
    ],
)
def test_lenient_double(spark, text, number):
    assert one(spark, text, "string", lenient_double(F.col("x"))) == number


def test_lenient_double_infinities(spark):
    assert one(spark, "-inf", "string", lenient_double(F.col("x"))) == float("-inf")
    assert str(one(spark, "NaN", "string", lenient_double(F.col("x")))) == "nan"


@pytest.mark.parametrize(
    "text, day",
    [
        ("2025-01-05", date(2025, 1, 5)),
        ("2025-1-5", date(2025, 1, 5)),
        ("2025-01-05T10:20:30Z", date(2025, 1, 5)),
        ("2025-1-5T10:20", None),
        ("2025-02-30", None),
        ("25-01-01", None),
        ("0000-01-01", None),
        ("2025/01/05", None),
        ("", None),
        (None, None),
    ],
)
def test_lenient_date(spark, text, day):
    assert one(spark, text, "string", lenient_date(F.col("x"))) == day


def sha(text, charset="utf-8"):
    return hashlib.sha256(text.encode(charset)).digest()


def test_person_key_ignores_case(spark):
    assert bytes(one(spark, "A.B@X.test", "string", person_key(F.col("x")))) == sha("a.b@x.test")
    assert one(spark, None, "string", person_key(F.col("x"))) is None


def test_person_key_charset(spark):
    wide = one(spark, "Ab@x", "string", person_key(F.col("x"), "UTF-16LE"))
    assert bytes(wide) == sha("ab@x", "utf-16-le")


def test_row_hashes(spark):
    df = spark.createDataFrame([(" a b ", None, 7)], "s string, n string, i int")
    got = df.select(
        row_hash_delimited(F.col("s"), F.col("n"), F.col("i")),
        row_hash_plain(F.col("s"), F.col("n"), F.col("i")),
        row_hash_strict(F.col("s"), F.col("i")),
        row_hash_strict(F.col("s"), F.col("n")),
    ).head()
    assert bytes(got[0]) == sha("A B||7")
    assert bytes(got[1]) == sha(" a b None7")
    assert bytes(got[2]) == sha(" a b 7")
    assert got[3] is None


@pytest.mark.parametrize(
    "a, b, changed",
    [
        (None, "", False),
        ("", None, False),
        (None, None, False),
        ("x", None, True),
        ("x", "y", True),
        ("x", "x", False),
    ],
)
def test_differs_takes_null_for_the_sentinel(spark, a, b, changed):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(differs(F.col("a"), F.col("b"), "")).head()[0] is changed


def test_blanks(spark):
    assert one(spark, " \t ", "string", blank_to_null(F.col("x"))) is None
    assert one(spark, "\tab c \n", "string", blank_to_null(F.col("x"))) == "ab c"
    for blank in (None, "", "   "):
        assert one(spark, blank, "string", default_if_blank(F.col("x"), "none")) == "none"
    assert one(spark, " a", "string", default_if_blank(F.col("x"), "none")) == " a"


def mean(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x decimal(9,4)")
    agg = df.agg(F.sum("x").alias("s"), F.count("x").alias("n"), F.count(F.lit(1)).alias("r"))
    return agg.select(strict_mean(F.col("s"), F.col("n"), F.col("r"))).head()[0]


def test_strict_mean(spark):
    assert mean(spark, [Decimal(1), Decimal(2)]) == Decimal("1.50")
    assert mean(spark, [Decimal(1), None]) is None
    # ties round away from zero, on decimals
    assert mean(spark, [Decimal("1.0050")]) == Decimal("1.01")
    assert mean(spark, [Decimal("-1.0050")]) == Decimal("-1.01")
    assert mean(spark, [Decimal("1.0049"), Decimal("1.0050")]) == Decimal("1.00")


def test_dates(spark):
    leap = date(2024, 2, 29)
    assert one(spark, leap, "date", add_years(F.col("x"), -2)) == date(2022, 2, 28)
    assert one(spark, leap, "date", date_key(F.col("x"))) == 20240229
    assert one(spark, date(2025, 12, 29), "date", iso_year(F.col("x"))) == 2026
    assert one(spark, date(2021, 1, 3), "date", iso_year(F.col("x"))) == 2020
    assert first_of_month(datetime(2024, 3, 31, 5)) == date(2024, 3, 1)
    assert last_of_previous_month(date(2024, 3, 31)) == leap
