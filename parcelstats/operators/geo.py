"""Regions from parcel keys and census tracts, special complexes (OP-8, OP-9, OP-26)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.operators.skew import SLICES, join_spread
from parcelstats.reference_data import (
    CENTRAL_CONDOS,
    OTHER_CONDOS,
    RESIDENT_CLASSES,
    SPECIAL_CONDOS,
    TRACT_REGIONS,
    ZONE_REGIONS,
    lookup,
    special_complexes,
)


def add_zone_region(df: DataFrame, key: str = "tmk") -> DataFrame:
    """Add ``zone_section``, one flag per area, and ``region`` (null where unmapped)."""
    zoned = df.withColumn(
        "zone_section", F.substring(F.col(key).cast("string"), 2, 2).cast("bigint")
    )
    region = F.lit(None).cast("string")
    for name, _, codes in reversed(ZONE_REGIONS):
        region = F.when(F.col("zone_section").isin(codes), F.lit(name)).otherwise(region)
    flags = {flag: F.col("zone_section").isin(codes) for _, flag, codes in ZONE_REGIONS}
    return zoned.withColumns({**flags, "region": region})


def add_tract_region(
    df: DataFrame, tract: str = "tracta", regions: dict[int, str] | None = None
) -> DataFrame:
    """Add ``region`` by tract code, else by the code floored to hundreds; drop unmapped."""
    regions = TRACT_REGIONS if regions is None else regions
    code = F.col(tract).cast("bigint")
    base = F.floor(code / 100) * 100
    return (
        df.withColumn(tract, code)
        .withColumn("region", F.coalesce(lookup(regions, code), lookup(regions, base)))
        .filter(F.col("region").isNotNull())
    )


def add_complex_code(df: DataFrame, key: str = "tmk") -> DataFrame:
    """Add ``tmk_sub``, the eight digits after the county digit."""
    return df.withColumn("tmk_sub", F.substring(F.col(key).cast("string"), 2, 8).cast("bigint"))


def mark_special_complexes(
    df: DataFrame,
    complexes: DataFrame | None = None,
    hot: DataFrame | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """Add ``is_special``: whether ``tmk_sub`` is one of the special complexes.

    The built-in list is broadcast and adds ``complex_name``. A list of the caller's
    has no known size: it is joined on the key, with the ``hot`` keys spread.
    """
    if complexes is None:
        names = special_complexes(df.sparkSession).withColumn("is_special", F.lit(True))
        marked = df.join(F.broadcast(names), "tmk_sub", "left")
    else:
        codes = complexes.select("tmk_sub").distinct().withColumn("is_special", F.lit(True))
        if hot is None:
            marked = df.join(codes, "tmk_sub", "left")
        else:
            marked = join_spread(df, codes, "tmk_sub", hot, "left", slices)
    return marked.withColumn("is_special", F.coalesce(F.col("is_special"), F.lit(False)))


def special_complex_split(df: DataFrame) -> DataFrame:
    """Add ``desc``, the condominium subset of a row, and drop rows of no subset.

    The three subsets do not overlap, so that one label replaces three passes.
    Expects ``is_special``, ``is_condo``, the area flags and ``tax_rate_class``.
    """
    west_south = F.col("is_west_maui") | F.col("is_south_maui")
    resident = F.col("tax_rate_class").isin(RESIDENT_CLASSES)
    subset = (
        F.when(F.col("is_special") & west_south, F.lit(SPECIAL_CONDOS))
        .when(~F.col("is_special") & west_south & resident, F.lit(OTHER_CONDOS))
        .when(F.col("is_central_maui") & resident, F.lit(CENTRAL_CONDOS))
    )
    return (
        df.filter(F.col("is_condo"))
        .withColumn("desc", subset)
        .filter(F.col("desc").isNotNull())
    )
