"""Household income by region (PIPE-9, PIPE-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.operators.census import county_income, tract_income, tract_population
from parcelstats.operators.geo import add_tract_region
from parcelstats.operators.inflation import adjust_for_inflation, deflate_to_nominal
from parcelstats.operators.quantiles import weighted_median
from parcelstats.operators.series import (
    annual_reference_income,
    interpolate_by_reference,
    splice_series,
)
from parcelstats.reference_data import (
    COUNTY,
    INCOME_BASE_YEAR,
    INTERPOLATED_INCOME_BASE_YEAR,
    LANAI_FIRST_YEAR,
)

INCOME = "median_household_income"
ADJUSTED = f"adj_{INCOME}"
COLUMNS = ["year", "region", ADJUSTED, INCOME]


def _regions(tracts: DataFrame, population: DataFrame, cpi: DataFrame, base_year: int) -> DataFrame:
    """(year, region, adjusted income): medians of the tracts, weighted by population.

    Years without population give no rows.
    """
    weighted = tract_income(tracts).join(tract_population(population), ["year", "tracta"], "left")
    adjusted = adjust_for_inflation(add_tract_region(weighted), cpi, INCOME, base_year)
    known = adjusted.filter(F.col("year").isNotNull())
    return weighted_median(known, ["year", "region"], ADJUSTED, "persons_total")


def _county(county: DataFrame, cpi: DataFrame, base_year: int) -> DataFrame:
    adjusted = adjust_for_inflation(county_income(county), cpi, INCOME, base_year)
    return adjusted.select(
        "year", F.lit(COUNTY).alias("region"), ADJUSTED, F.col(INCOME).cast("bigint").alias(INCOME)
    )


def _published(rows: DataFrame, order: list[str]) -> DataFrame:
    """Regions, then the county; Lanai only from the first year with tracts of its own."""
    known = (F.col("region") != "Lanai") | (F.col("year") >= LANAI_FIRST_YEAR)
    is_county = F.col("region") == COUNTY
    return rows.filter(known).orderBy(is_county, *order).select(*COLUMNS)


def household_income(
    tracts: DataFrame,
    county: DataFrame,
    population: DataFrame,
    cpi: DataFrame,
    base_year: int = INCOME_BASE_YEAR,
) -> DataFrame:
    """Median household income per region and census year, and of the county."""
    regions = _regions(tracts, population, cpi, base_year)
    nominal = deflate_to_nominal(regions, cpi, INCOME, base_year).select(*COLUMNS)
    county_years = _county(county, cpi, base_year).select(*COLUMNS)
    return _published(nominal.unionByName(county_years), ["year", "region"])


def household_income_interpolated(
    tracts: DataFrame,
    county: DataFrame,
    population: DataFrame,
    cpi: DataFrame,
    state_reference: DataFrame,
    county_reference: DataFrame,
    base_year: int = INTERPOLATED_INCOME_BASE_YEAR,
) -> DataFrame:
    """Median household income per region and for the county, for every year.

    Census years are joined up along an annual series: that of the state before the
    switch year, that of the county from it on.
    """
    annual = splice_series(
        annual_reference_income(state_reference), annual_reference_income(county_reference)
    )
    reference = adjust_for_inflation(annual, cpi, INCOME, base_year).select("year", ADJUSTED)
    regions = _regions(tracts, population, cpi, base_year)
    county_years = _county(county, cpi, base_year)
    # A row per region and census year; the county is one more region to fill.
    known = regions.unionByName(county_years.select(*regions.columns))
    filled = interpolate_by_reference(known, reference, ADJUSTED)
    return _published(deflate_to_nominal(filled, cpi, INCOME, base_year), ["region", "year"])
