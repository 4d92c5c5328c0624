"""Dense category grids and decade bins (OP-14, OP-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.reference_data import FIRST_BUILT_YEAR, LAST_BUILT_YEAR

#: Values of a dimension that are attached to a row at once.
BLOCK = 10_000
#: Combinations that one task makes where the values are not broadcast.
TASK_ROWS = 1_000_000


def dense_counts(counts: DataFrame, dims: Sequence[str], count: str) -> DataFrame:
    """Every combination of the observed values of ``dims``; missing counts become 0.

    ``counts`` is already aggregated to one row per combination. The first dimension
    may have any number of values: it stays distributed, and the value lists of the
    others are attached to each of its rows in blocks of about ``BLOCK``, each an array
    that a row finds by the block's number. A null value takes part in the grid but matches
    no count. Other columns stay null for missing combinations.
    """
    first, *others = dims
    grid = counts.select(first).distinct()
    n_rows = grid.agg(F.count("*")).scalar()
    for dim in others:
        values = counts.select(dim).distinct()
        n_values = values.agg(F.count("*")).scalar()
        grid = with_each_value(grid, values, n_rows, n_values)
        n_rows = n_rows * n_values
    filled = F.coalesce(F.col(count), F.lit(0).cast("bigint"))
    return grid.join(counts, list(dims), "left").withColumn(count, filled)


def with_each_value(rows: DataFrame, domain: DataFrame, n_rows: Column, n_values: Column) -> DataFrame:
    """Each of ``rows`` with each value of ``domain``, one column of distinct values.

    The values come in arrays of about ``BLOCK`` that a row finds by the array's number and by
    a salt of the row. There are as many salts, each with a copy of the arrays, as leave a
    task about ``TASK_ROWS`` combinations, so few blocks do not mean few tasks. ``n_rows`` and
    ``n_values`` are the numbers of rows of the two sides.
    """
    (name,) = domain.columns
    n_blocks = F.greatest(F.lit(1), F.ceil(n_values / BLOCK)).cast("int")
    n_salts = F.greatest(F.lit(1), F.ceil(n_rows * (n_values / n_blocks) / TASK_ROWS)).cast("int")
    number = F.pmod(F.xxhash64(name), n_blocks.cast("bigint")).cast("int").alias("_block")
    blocks = (
        domain.select(number, F.struct(name).alias("_value"))
        .groupBy("_block")
        .agg(F.collect_set("_value").alias("_values"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), n_salts - 1)))
    )
    salt = F.pmod(F.xxhash64(*rows.columns), n_salts.cast("bigint")).cast("int")
    return (
        rows.withColumns({"_block": F.explode(F.sequence(F.lit(0), n_blocks - 1)), "_salt": salt})
        .join(blocks, ["_block", "_salt"])
        .withColumn("_value", F.explode("_values"))
        .select(*rows.columns, F.col(f"_value.{name}").alias(name))
    )


def add_decade(
    df: DataFrame,
    year: str = "year_built",
    first: int = FIRST_BUILT_YEAR,
    last: int = LAST_BUILT_YEAR,
) -> DataFrame:
    """Keep years within the limits and add ``decade``."""
    return df.filter(F.col(year).between(first, last)).withColumn(
        "decade", F.floor(F.col(year) / 10) * 10
    )


def decade_span(first: Column, last: Column) -> list[Column]:
    """``decade_desc`` and ``num_years`` of a decade from its first and last observed year."""
    return [
        F.concat_ws("-", first, last).alias("decade_desc"),
        (last - first + 1).alias("num_years"),
    ]


def decade_bins(df: DataFrame, first: str = "year_built", last: str | None = None) -> DataFrame:
    """Per decade the observed year range as ``decade_desc`` and its ``num_years``.

    ``first`` and ``last`` are the lowest and highest year of a row: the same column
    for single rows, two columns for input that is already aggregated.
    """
    return (
        df.groupBy("decade")
        .agg(F.min(first).alias("_start"), F.max(last or first).alias("_end"))
        .select("decade", *decade_span(F.col("_start"), F.col("_end")))
    )
