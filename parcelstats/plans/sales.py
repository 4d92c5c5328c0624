"""Median sale prices by region and year (PIPE-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.operators.geo import add_zone_region
from parcelstats.operators.inflation import adjust_for_inflation
from parcelstats.operators.keys import dedupe_bundle_sales, valid_parcel_key
from parcelstats.operators.levels import median_by_level
from parcelstats.operators.property import (
    home_type,
    main_dwellings,
    residential_parcels,
    sale_normalise,
)
from parcelstats.operators.skew import HOT_ROWS, hot_keys, join_spread
from parcelstats.reference_data import PROPERTY_BASE_YEAR


def residential_sales(
    assessments: DataFrame, dwellings: DataFrame, sales: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per recorded sale of residential parcels with a dwelling.

    Sales need no more of a parcel than its key and whether its main dwelling is a
    condominium. Region and home type follow from these, after the last wide exchange.
    """
    parcels = residential_parcels(assessments).select("tmk").distinct()
    homes = parcels.join(main_dwellings(dwellings).select("tmk", "is_condo"), "tmk")
    # Only valid keys can match. Stated here, it makes the two uses of the hot keys alike,
    # so that the sales are counted once.
    recorded = valid_parcel_key(sale_normalise(sales))
    sold = join_spread(recorded, homes, "tmk", hot_keys(recorded, "tmk", hot_rows))
    return (
        add_zone_region(dedupe_bundle_sales(sold))
        .withColumn("home_type", home_type(F.col("is_condo")))
        .withColumnRenamed("sale_year", "year")
    )


def property_sales(
    assessments: DataFrame,
    dwellings: DataFrame,
    sales: DataFrame,
    cpi: DataFrame,
    is_condo: bool,
    base_year: int = PROPERTY_BASE_YEAR,
) -> DataFrame:
    """region, year, price, adj_price, count of condominiums or of single family homes.

    Dwellings of unknown type are in neither.
    """
    sold = residential_sales(assessments, dwellings, sales).filter(F.col("is_condo") == is_condo)
    priced = adjust_for_inflation(sold, cpi, "price", base_year)
    # Eight regions and the years that sale_normalise lets through.
    return median_by_level(priced, ["price", "adj_price"])


def single_family_home_sales(
    assessments: DataFrame, dwellings: DataFrame, sales: DataFrame, cpi: DataFrame
) -> DataFrame:
    return property_sales(assessments, dwellings, sales, cpi, is_condo=False)


def condo_sales(
    assessments: DataFrame, dwellings: DataFrame, sales: DataFrame, cpi: DataFrame
) -> DataFrame:
    return property_sales(assessments, dwellings, sales, cpi, is_condo=True)
