"""Scalar helpers: the edge cases that decide a result."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from obs_engine.functions import (
    clock_diff,
    clock_seconds,
    day_of,
    normalised,
    quoted,
    rounded,
    whole_number,
    year_month,
    year_of,
)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "value, expected",
    [
        (2.345, "2.35"),
        (-2.345, "-2.35"),
        (2.3449999999999998, "2.35"),  # 0.1 + 0.2 + 2.045: 15 digits make it 2.345
        (2.344, "2.34"),
        (0.0, "0.00"),
        (1e-12, "0.00"),
        (1234567.125, "1234567.13"),
    ],
)
def test_rounded_is_half_away_from_zero(spark, value, expected):
    assert one(spark, rounded(F.lit(value))) == Decimal(expected)


def test_rounded_keeps_null(spark):
    assert one(spark, rounded(F.lit(None).cast("double"))) is None


def test_normalised_strips_spaces_only(spark):
    assert one(spark, normalised(F.lit(" sunny "))) == "SUNNY"
    assert one(spark, normalised(F.lit("\tsunny"))) == "\tSUNNY"


def test_days(spark):
    assert one(spark, day_of(F.lit("2022-10-05"))) == dt.date(2022, 10, 5)
    assert one(spark, day_of(F.lit("2022-1-5"))) == dt.date(2022, 1, 5)
    assert one(spark, year_month(F.lit("2022-1-5"))) == "2022-01"
    assert one(spark, year_of(F.lit("2022-10-05"))) == 2022
    assert one(spark, day_of(F.lit("soon"), tolerant=True)) is None
    with pytest.raises(PySparkException):
        one(spark, day_of(F.lit("soon")))


def test_whole_number(spark):
    def cast(value, dtype):
        df = spark.range(1).select(F.lit(value).cast(dtype).alias("x"))
        return df.select(whole_number("x", df.schema["x"].dataType)).first()[0]

    assert cast(" 84 ", "string") == 84
    assert cast(79.5, "double") == 80
    assert cast(80.5, "double") == 80  # half to even for doubles
    assert cast("80.5", "decimal(5,2)") == 81  # half away from zero for decimals
    assert cast(7, "bigint") == 7
    with pytest.raises(PySparkException):
        cast("84.0", "string")


def test_clock(spark):
    rise, end = F.lit("05:30 AM"), F.lit("07:15 PM")
    assert one(spark, clock_diff(end, rise)) == dt.timedelta(seconds=49_500)
    assert one(spark, clock_seconds(end, rise)) == 49_500
    assert one(spark, clock_seconds(rise, end)) == -49_500  # no wrap past midnight
    assert one(spark, clock_diff(end, F.lit(None).cast("string"))) is None


def test_quoted():
    assert quoted("a.b") == "`a.b`"
    assert quoted("a`b") == "`a``b`"
