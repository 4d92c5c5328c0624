"""Typed CSV extracts with the columns the statistics use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelstats.sources.csv import read_csv

EXTRACTS = {
    "assessments": {
        "tmk": "bigint",
        "tax_rate_class": "string",
        "assessed_building_value": "bigint",
        "assessed_land_value": "bigint",
        "building_exemption": "bigint",
    },
    "dwellings": {
        "tmk": "bigint",
        "sf_of_living_area": "bigint",
        "year_built": "bigint",
        "bed_rooms": "bigint",
        "condo_type": "bigint",
    },
    "owners": {"tmk": "bigint", "mailing_zip1": "bigint", "country": "string"},
    "sales": {
        "parid": "bigint",
        "saledate": "string",
        "recorddate": "string",
        "price": "bigint",
        "instruno": "string",
        "landcourt_no": "string",
        "cert_no": "string",
    },
    "cpi": {"year": "bigint", "annual": "double"},
    "tract_income": {"year": "string", "state": "string", "tracta": "bigint", "b79aa": "int"},
    "county_income": {"year": "string", "state": "string", "county": "string", "b79aa": "int"},
    "tract_population": {"year": "string", "state": "string", "tracta": "bigint", "av0aa": "int"},
    "reference_income": {"observation_date": "string", "median_household_income": "string"},
    "household_income": {
        "year": "bigint",
        "region": "string",
        "adj_median_household_income": "bigint",
        "median_household_income": "bigint",
    },
    "property_sales": {
        "region": "string",
        "year": "bigint",
        "price": "bigint",
        "adj_price": "bigint",
        "count": "bigint",
    },
}


def read_extract(spark: SparkSession, name: str, path: str) -> DataFrame:
    """One of ``EXTRACTS`` from CSV; the CPI column ``annual`` is renamed to ``cpi``."""
    types = EXTRACTS[name]
    df = read_csv(spark, path, list(types), types)
    return df.withColumnRenamed("annual", "cpi") if name == "cpi" else df
