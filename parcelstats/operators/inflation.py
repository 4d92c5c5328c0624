"""Inflation adjustment and its inverse (OP-5, OP-5b) and annual series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.functions import rounded_long


def annual_series(df: DataFrame, value: str, year: str = "year") -> DataFrame:
    """(year, value) with one row per year, whatever the year.

    A year with two rows fails the query instead of multiplying the rows joined to it.
    """
    message = F.concat(F.lit("more than one row for year "), F.col(year).cast("string"))
    single = F.when(F.count("*") == 1, F.max(value)).otherwise(F.raise_error(message))
    return (
        df.select(F.col(year).try_cast("bigint").alias(year), value)
        .filter(F.col(year).isNotNull())
        .groupBy(year)
        .agg(single.alias(value))
    )


def price_index(cpi: DataFrame, base_year: int) -> DataFrame:
    """(year, cpi, base_cpi); fails without the base year."""
    series = annual_series(cpi.select("year", F.col("cpi").cast("double").alias("cpi")), "cpi")
    base = series.filter(F.col("year") == base_year).agg(F.max("cpi")).scalar()
    missing = F.raise_error(F.lit(f"no cpi for base year {base_year}"))
    return series.select("year", "cpi", F.coalesce(base, missing).alias("base_cpi"))


def _with_cpi(df: DataFrame, cpi: DataFrame, base_year: int) -> DataFrame:
    dated = df.withColumn("year", F.col("year").cast("bigint"))
    return dated.join(price_index(cpi, base_year), "year", "left")


def adjust_for_inflation(
    df: DataFrame, cpi: DataFrame, column: str, base_year: int
) -> DataFrame:
    """Add ``adj_<column>``: the amount in money of ``base_year``; null without a CPI."""
    amount = F.col(column).cast("double")
    adjusted = F.try_divide(amount, F.col("cpi")) * F.col("base_cpi")
    priced = _with_cpi(df, cpi, base_year).withColumn(f"adj_{column}", rounded_long(adjusted))
    return priced.drop("cpi", "base_cpi")


def deflate_to_nominal(df: DataFrame, cpi: DataFrame, column: str, base_year: int) -> DataFrame:
    """Add ``column`` in money of its own year from ``adj_<column>``."""
    amount = F.col(f"adj_{column}").cast("double")
    nominal = F.try_divide(amount, F.col("base_cpi")) * F.col("cpi")
    priced = _with_cpi(df, cpi, base_year).withColumn(column, rounded_long(nominal))
    return priced.drop("cpi", "base_cpi")
