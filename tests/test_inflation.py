"""OP-5, OP-5b."""

import pytest

from parcelstats.operators.census import regional_income
from parcelstats.operators.inflation import adjust_for_inflation, deflate_to_nominal
from tests.helpers import bag, rows

CPI = [(2000, 100.0), (2010, 150.0), (2023, 300.0)]


def cpi(spark, extra=()):
    return spark.createDataFrame([*CPI, *extra], "year long, cpi double")


def test_amounts_move_to_the_base_year(spark):
    df = spark.createDataFrame([("2000", 10), ("2010", 11), ("1999", 5), ("2023", None)], "year string, x long")
    found = adjust_for_inflation(df, cpi(spark), "x", 2023)
    assert found.columns == ["year", "x", "adj_x"]
    assert bag(found) == [(1999, 5, None), (2000, 10, 30), (2010, 11, 22), (2023, None, None)]


def test_round_trip_returns_the_amount(spark):
    df = spark.createDataFrame([(2000, x) for x in range(1, 200)], "year long, amount long")
    adjusted = adjust_for_inflation(df, cpi(spark), "amount", 2023)
    nominal = deflate_to_nominal(adjusted.drop("amount"), cpi(spark), "amount", 2023)
    assert bag(nominal, "amount") == [(x,) for x in range(1, 200)]


def test_half_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(2010, 1), (2010, -1)], "year long, x long")
    assert bag(adjust_for_inflation(df, cpi(spark), "x", 2000), "adj_x") == [(-1,), (1,)]
    half = spark.createDataFrame([(2023, 150)], "year long, x long")
    assert rows(adjust_for_inflation(half, cpi(spark, [(2001, 1.0)]), "x", 2001), "adj_x") == [(1,)]


def test_a_missing_base_year_fails(spark):
    df = spark.createDataFrame([(2000, 1)], "year long, x long")
    with pytest.raises(Exception, match="no cpi for base year 1999"):
        rows(adjust_for_inflation(df, cpi(spark), "x", 1999))


def test_a_repeated_year_fails(spark):
    df = spark.createDataFrame([(2000, 1)], "year long, x long")
    with pytest.raises(Exception, match="more than one row for year 2000"):
        rows(adjust_for_inflation(df, cpi(spark, [(2000, 1.0)]), "x", 2023))


def test_regional_income_keeps_every_region_and_year_once(spark):
    data = [("Lanai", 2000, 1), ("Maui County", 2000, 2), ("Elsewhere", 2000, 3), ("Lanai", 9999, 4)]
    df = spark.createDataFrame(data, "region string, year long, i long")
    found = bag(regional_income(df, ["i"]))
    assert {("Elsewhere", 2000, 3), ("Lanai", 2000, 1), ("Lanai", 9999, 4), ("Maui County", 2000, 2)} == set(found)
    with pytest.raises(Exception, match="more than one income row"):
        rows(regional_income(df.union(df), ["i"]))
