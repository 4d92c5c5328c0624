"""Parcels, dwellings, owners and sales (OP-16, 17, 19..22, 27)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.functions import year_prefix
from parcelstats.operators.geo import add_zone_region
from parcelstats.operators.keys import (
    BUNDLE_KEYS,
    first_per_key,
    largest_per_key,
    valid_parcel_key,
)
from parcelstats.reference_data import (
    FIRST_SALE_YEAR,
    LAST_SALE_YEAR,
    LOCAL_POSTAL_CODES,
    MIN_AREA,
    MIN_PRICE,
    RESIDENT_CLASSES,
    RESIDENTIAL_CLASSES,
    SALE_COUNTY_DIGIT,
)

ASSESSED_VALUES = ["assessed_building_value", "assessed_land_value", "building_exemption"]
# Total order of the dwellings of a parcel behind the area.
DWELLING_ORDER = ["year_built", "bed_rooms", "is_condo"]


def residential_filter(df: DataFrame) -> DataFrame:
    return df.filter(F.col("tax_rate_class").isin(RESIDENTIAL_CLASSES))


def home_type(is_condo: Column) -> Column:
    """A dwelling of unknown type counts as a single family home."""
    return F.when(is_condo, F.lit("Condo")).otherwise(F.lit("Single Family Home"))


def dwelling_attributes(df: DataFrame, min_area: int = MIN_AREA) -> DataFrame:
    """Replace ``condo_type`` by ``is_condo``, add ``home_type``, null tiny areas."""
    area = F.col("sf_of_living_area")
    return (
        df.withColumn("is_condo", F.col("condo_type") > 0)
        .drop("condo_type")
        .withColumns(
            {
                "home_type": home_type(F.col("is_condo")),
                "sf_of_living_area": F.when(area >= min_area, area),
            }
        )
    )


def residential_parcels(assessments: DataFrame) -> DataFrame:
    """Rows of valid residential parcels; a parcel may still have several."""
    return residential_filter(valid_parcel_key(assessments))


def one_row_per_parcel(parcels: DataFrame) -> DataFrame:
    """The first row in the order of tax class, then the other columns."""
    rest = [c for c in parcels.columns if c not in ("tmk", "tax_rate_class")]
    return first_per_key(parcels, ["tmk"], ["tax_rate_class", *rest])


def main_dwellings(dwellings: DataFrame) -> DataFrame:
    """The largest dwelling per parcel; one without a usable area comes first."""
    keyed = dwellings.withColumn("tmk", F.col("tmk").try_cast("bigint"))
    return largest_per_key(
        dwelling_attributes(keyed), ["tmk"], "sf_of_living_area", tie_break=DWELLING_ORDER
    )


def parcel_dwelling_base(assessments: DataFrame, dwellings: DataFrame) -> DataFrame:
    """One row per residential parcel with a dwelling.

    Both sides come down to one row per parcel before the join and leave it
    partitioned by parcel: no further exchange, and no hot key in it. The region
    columns follow from the key and are added last.
    """
    parcels = one_row_per_parcel(residential_parcels(assessments))
    return add_zone_region(parcels.join(main_dwellings(dwellings), "tmk"))


def sale_normalise(
    df: DataFrame,
    min_price: int = MIN_PRICE,
    first_year: int = FIRST_SALE_YEAR,
    last_year: int = LAST_SALE_YEAR,
) -> DataFrame:
    """Sales keyed by parcel with their year, low prices and other years removed."""
    sale_year, record_year = year_prefix("saledate"), year_prefix("recorddate")
    year = F.when(sale_year == 1900, record_year).otherwise(F.coalesce(sale_year, record_year))
    parcel = F.concat(F.lit(SALE_COUNTY_DIGIT), F.col("parid").cast("string"))
    return (
        df.filter(F.col("price") > min_price)
        .select(parcel.cast("bigint").alias("tmk"), year.alias("sale_year"), *BUNDLE_KEYS)
        .filter(F.col("sale_year").between(first_year, last_year))
    )


def owner_rollup(df: DataFrame) -> DataFrame:
    """Per parcel the highest postal code and whether any owner is local."""
    local = F.col("mailing_zip1").isin(LOCAL_POSTAL_CODES)
    return df.groupBy("tmk").agg(
        F.max("mailing_zip1").alias("mailing_zip"),
        F.coalesce(F.bool_or(local), F.lit(False)).alias("is_maui_owner"),
    )


def _per_area(value: Column, area: Column) -> Column:
    return F.round(F.try_divide(value.cast("double"), area.cast("double")), 0)


def add_price_per_sqft(df: DataFrame) -> DataFrame:
    """Add ``ppsf``, the rounded building value per area where the area is positive."""
    area = F.col("sf_of_living_area")
    return df.withColumn(
        "ppsf", F.when(area > 0, _per_area(F.col("assessed_building_value"), area))
    )


def add_resident_type(df: DataFrame) -> DataFrame:
    resident = F.col("tax_rate_class").isin(RESIDENT_CLASSES)
    return df.withColumn(
        "resident_type", F.when(resident, F.lit("Resident")).otherwise(F.lit("Non-Resident"))
    )


def parcel_enriched(
    current: DataFrame, prior: DataFrame, dwellings: DataFrame, owners: DataFrame
) -> DataFrame:
    """One row per residential parcel with prior-year values, dwellings and owners.

    The result is that of joining all rows of a parcel and then taking the greatest
    area, price per area and local-owner flag and the first of every other column.
    The rows of a parcel are not paired for it: each input first comes down to one
    row per parcel. The greatest ratio over all pairs of a building value and an area
    is that of the greatest value over the smallest area (the greatest area if no
    value is positive), and the first of all pairs is the pair of the firsts.
    """
    parcels = one_row_per_parcel(residential_parcels(current.select("tmk", "tax_rate_class")))

    assessed = valid_parcel_key(prior.select("tmk", *ASSESSED_VALUES)).groupBy("tmk").agg(
        F.min(F.struct(*ASSESSED_VALUES)).alias("_first"),
        F.max("assessed_building_value").alias("_top_value"),
    )

    area = F.col("sf_of_living_area")
    # Ascending order on the negated area: null first, then the largest.
    ordered = F.struct((-area).alias("_area"), *DWELLING_ORDER)
    built = (
        dwelling_attributes(dwellings.withColumn("tmk", F.col("tmk").try_cast("bigint")))
        .groupBy("tmk")
        .agg(
            F.min(ordered).alias("_dwelling"),
            F.max(area).alias("_top_area"),
            F.min(F.when(area > 0, area)).alias("_low_area"),
        )
    )

    area_for_top = F.when(F.col("_top_value") >= 0, F.col("_low_area")).otherwise(F.col("_top_area"))
    joined = (
        parcels.join(built, "tmk")
        .join(assessed, "tmk", "left")
        .join(owner_rollup(owners), "tmk", "left")
    )
    return add_resident_type(
        add_zone_region(
            joined.select(
                "tmk",
                "tax_rate_class",
                *[F.col(f"_first.{c}").alias(c) for c in ASSESSED_VALUES],
                F.col("_top_area").alias("sf_of_living_area"),
                *[F.col(f"_dwelling.{c}").alias(c) for c in DWELLING_ORDER],
                home_type(F.col("_dwelling.is_condo")).alias("home_type"),
                _per_area(F.col("_top_value"), area_for_top).alias("ppsf"),
                "mailing_zip",
                "is_maui_owner",
            )
        )
    )
