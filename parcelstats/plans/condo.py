"""Characteristics of condominium subsets (PIPE-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelstats.operators.geo import (
    add_complex_code,
    mark_special_complexes,
    special_complex_split,
)
from parcelstats.operators.keys import valid_parcel_key
from parcelstats.operators.levels import profile
from parcelstats.operators.property import parcel_dwelling_base
from parcelstats.operators.skew import HOT_ROWS, hot_keys
from parcelstats.reference_data import CENTRAL_CONDOS, OTHER_CONDOS, SPECIAL_CONDOS


def condo_characteristics(
    assessments: DataFrame,
    dwellings: DataFrame,
    complexes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Size, medians and shares of three subsets of condominiums.

    ``complexes`` (tmk_sub) replaces the built-in list of special complexes. Its hot
    codes are counted on the assessments, which have at least as many rows per code.
    """
    needed = assessments.select("tmk", "tax_rate_class", "assessed_building_value")
    homes = add_complex_code(parcel_dwelling_base(needed, dwellings))
    hot = None
    if complexes is not None:
        hot = hot_keys(add_complex_code(valid_parcel_key(needed)), "tmk_sub", hot_rows)
    condos = special_complex_split(mark_special_complexes(homes, complexes, hot))
    return profile(condos, [SPECIAL_CONDOS, OTHER_CONDOS, CENTRAL_CONDOS])
