"""Parcel keys and deterministic row selection per key (OP-2, OP-3, OP-4, OP-18)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstats.functions import lenient_long
from parcelstats.reference_data import PARCEL_KEY_DIGITS

BUNDLE_KEYS = ["saledate", "price", "recorddate", "instruno", "landcourt_no", "cert_no"]


def valid_parcel_key(
    df: DataFrame, column: str = "tmk", digits: int = PARCEL_KEY_DIGITS
) -> DataFrame:
    """Keep rows whose key is a whole number written with ``digits`` characters.

    The length test is stated as value ranges, which reach the Parquet scan; the
    second range is that of negative numbers, whose sign counts as a character.
    """
    key = F.col(column)
    positive = key.between(10 ** (digits - 1), 10**digits - 1)
    negative = key.between(1 - 10 ** (digits - 1), -(10 ** (digits - 2)))
    return df.withColumn(column, lenient_long(column)).filter(positive | negative)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """One whole row per key set, the first in ``order``; null keys form a group.

    ``order`` should be total on a group. The rank limit also runs before the
    exchange, so a hot key sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def largest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    tie_break: Sequence[Column | str] = (),
    nulls_first: bool = True,
) -> DataFrame:
    """The row with the greatest ``measure`` per key.

    With ``nulls_first`` a row without a measure wins over every measured row.
    """
    column = F.col(measure)
    order = column.desc_nulls_first() if nulls_first else column.desc_nulls_last()
    return first_per_key(df, keys, [order, *tie_break])


def dedupe_bundle_sales(
    df: DataFrame, bundle_keys: Sequence[str] = BUNDLE_KEYS, parcel: str = "tmk"
) -> DataFrame:
    """One row per recorded sale: parcels sold together keep the lowest parcel key.

    Columns outside the bundle key must depend on the bundle key and the parcel.
    A plain aggregate is enough then, and combines copies before the exchange.
    """
    carried = [c for c in df.columns if c not in bundle_keys and c != parcel]
    return (
        df.groupBy(*bundle_keys)
        .agg(F.min(parcel).alias(parcel), *[F.min_by(c, parcel).alias(c) for c in carried])
        .select(*df.columns)
    )
