"""Affordable sales and price-to-income ratios (PIPE-6, PIPE-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.operators.census import regional_income
from parcelstats.operators.levels import affordable_share
from parcelstats.plans.sales import residential_sales


def affordable_sales(
    assessments: DataFrame, dwellings: DataFrame, sales: DataFrame, household_income: DataFrame
) -> DataFrame:
    """Share of affordable sales per home type, region and year.

    Prices and incomes are both in money of their year, so no price index is needed.
    """
    income = regional_income(household_income, ["median_household_income"])
    return affordable_share(residential_sales(assessments, dwellings, sales), income)


def property_affordability(property_sales: DataFrame, household_income: DataFrame) -> DataFrame:
    """Ratio of median price to median household income per region and year.

    Feed it the interpolated incomes: those are in money of the same year as the
    prices, the plain household incomes by default are not.
    """
    income = regional_income(household_income, ["adj_median_household_income"])
    ratio = F.try_divide(
        F.col("adj_price").cast("double"), F.col("adj_median_household_income").cast("double")
    )
    return (
        property_sales.join(income, ["region", "year"])
        .select(
            "region",
            "year",
            F.round(ratio, 1).alias("price_to_income_ratio"),
            "adj_price",
            "adj_median_household_income",
        )
        .orderBy("region", "year")
    )
