from datetime import date

import pytest
from pyspark.sql import functions as F

from cartwheel.functions import columns as C


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_sums_of_money_are_exact_in_any_order(frame):
    values = [0.1, 0.2, -0.01, 1.1 + 0.1, 886731.09, None] * 1000
    df = frame("v double", *[(v,) for v in values])
    sums = [C.money_sum(F.col("v")).alias("s"), C.money_avg(F.col("v")).alias("a")]
    got = df.agg(*sums).first()
    assert (got.s, got.a) == (886732580.0, 886732580.0 / 5000)
    empty = df.limit(0).agg(*sums).first()
    assert (empty.s, empty.a) == (None, None)


def test_large_sums_do_not_wrap(frame):
    """More cents than a long holds; such sums used to fail."""
    df = frame("v double", (6e16,), (6e16,))
    assert df.agg(C.money_sum(F.col("v")).alias("s")).first().s == 1.2e17


@pytest.mark.parametrize("value, digits, want", [
    (886731.09 / 6, 2, 147788.52), (4.25, 1, 4.3), (-4.25, 1, -4.3), (1.005, 2, 1.01),
    (2 / 3 * 100, 2, 66.67), (0.0, 2, 0.0)])
def test_rounding_half_away_from_zero(spark, value, digits, want):
    assert one(spark, C.rounded(F.lit(value), digits)) == want


def test_ratio_by_zero_is_null(spark):
    assert one(spark, C.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, C.ratio(F.lit(1), F.lit(4))) == 0.25


@pytest.mark.parametrize("later, earlier, months", [
    (date(2024, 1, 31), date(2023, 12, 1), 1), (date(2024, 1, 1), date(2024, 1, 31), 0),
    (date(2025, 2, 1), date(2023, 12, 31), 14)])
def test_months_between_starts(spark, later, earlier, months):
    assert one(spark, C.months_between_starts(F.lit(later), F.lit(earlier))) == months


@pytest.mark.parametrize("text, want", [
    ("x" * 50, "x" * 50), ("x" * 51, "x" * 50 + "..."), ("", ""), (None, None)])
def test_shorten(spark, text, want):
    assert one(spark, C.shorten(F.lit(text).cast("string"), 50)) == want


def test_differs_treats_null_as_a_value(spark):
    null = F.lit(None).cast("int")
    assert one(spark, C.differs(null, F.lit(1))) and not one(spark, C.differs(null, null))


@pytest.mark.parametrize("value, digits, expected", [
    (1e25, 1, 1e25), (-3e300, 2, -3e300), (float("inf"), 1, float("inf")), (99999999999999999999.0, 0, 1e20),
    (2.25, 1, 2.3), (-2.25, 1, -2.3), (None, 1, None)])
def test_rounding_of_numbers_of_any_size(spark, value, digits, expected):
    row = spark.createDataFrame([(value,)], "x double").select(C.rounded(F.col("x"), digits).alias("r")).first()
    assert row.r == expected


def test_rounding_keeps_nan(spark):
    row = spark.sql("SELECT double('NaN') AS x").select(C.rounded(F.col("x"), 1).alias("r")).first()
    assert row.r != row.r
