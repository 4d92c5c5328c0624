"""Census extracts and the regional income table (OP-24)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.operators.series import normalise_year_ranges
from parcelstats.reference_data import COUNTY, STATE

INCOME_CODE = "b79aa"
POPULATION_CODE = "av0aa"


def _years(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.col("year").try_cast("bigint"))


def _text_years(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.col("year").cast("string"))


def tract_income(df: DataFrame, state: str = STATE) -> DataFrame:
    """(year, tracta, median_household_income) of one state.

    Casts are lenient: a descriptive second header row is removed by the state
    filter, but nothing promises that the filter runs before the casts.
    """
    selected = df.filter(F.col("state") == state)
    return _years(normalise_year_ranges(_text_years(selected))).select(
        "year",
        F.col("tracta").try_cast("bigint").alias("tracta"),
        F.col(INCOME_CODE).try_cast("int").alias("median_household_income"),
    )


def county_income(df: DataFrame, state: str = STATE, county: str = COUNTY) -> DataFrame:
    """(year, county, median_household_income) of one county."""
    selected = df.filter((F.col("state") == state) & (F.col("county") == county))
    return _years(normalise_year_ranges(_text_years(selected))).select(
        "year", "county", F.col(INCOME_CODE).try_cast("int").alias("median_household_income")
    )


def tract_population(df: DataFrame, state: str = STATE) -> DataFrame:
    """(year, tracta, persons_total) of one state."""
    return _years(df.filter(F.col("state") == state)).select(
        "year",
        F.col("tracta").try_cast("bigint").alias("tracta"),
        F.col(POPULATION_CODE).try_cast("int").alias("persons_total"),
    )


def regional_income(income: DataFrame, columns: list[str]) -> DataFrame:
    """Income rows, one per region and year, whatever the labels of the regions.

    A second row for a region and year fails the query instead of repeating sales.
    """
    message = F.concat_ws(" ", F.lit("more than one income row for"), "region", "year")
    return (
        income.filter(F.col("region").isNotNull() & F.col("year").isNotNull())
        .groupBy("region", "year")
        .agg(
            *[
                F.when(F.count("*") == 1, F.max(c)).otherwise(F.raise_error(message)).alias(c)
                for c in columns
            ]
        )
    )
