"""Summaries per group and over all groups (OP-6, OP-7) and group profiles (OP-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.functions import percent
from parcelstats.operators.quantiles import grouped_medians
from parcelstats.reference_data import AFFORDABLE_RATIO, COUNTY


def median_by_level(
    df: DataFrame,
    measures: Sequence[str],
    region: str = "region",
    period: str = "year",
    total_label: str = COUNTY,
) -> DataFrame:
    """Truncated medians and ``count`` per (region, period) and per period.

    The total rows carry ``total_label`` and follow the regions; rows of a null region stay
    apart from them.
    """
    levels = [[region, period], [period]]
    medians = grouped_medians(df, [region, period], measures, levels)
    label = F.when(F.col("level") == 1, F.lit(total_label)).otherwise(F.col(region))
    return (
        medians.withColumn(region, label)
        .orderBy("level", F.col(region).asc_nulls_first(), F.col(period).asc_nulls_first())
        .select(
            region,
            period,
            *[F.col(m).cast("bigint").alias(m) for m in measures],
            F.col("rows").alias("count"),
        )
    )


def affordable_share(
    sales: DataFrame,
    income: DataFrame,
    ratio: int = AFFORDABLE_RATIO,
    total_label: str = COUNTY,
) -> DataFrame:
    """Sales at or below ``ratio`` times the income, per home type, region and year.

    ``income`` is a bounded (region, year) table, see ``regional_income``. The total
    over the regions adds up the regional rows; its threshold is that of the
    alphabetically first region.
    """
    thresholds = income.select(
        "region", "year", (F.col("median_household_income") * ratio).alias("affordability_thresh")
    )
    by_region = (
        sales.join(thresholds, ["region", "year"])
        .groupBy("home_type", "region", "year")
        .agg(
            F.max("affordability_thresh").alias("affordability_thresh"),
            F.count("*").alias("total_count"),
            F.count_if(F.col("price") <= F.col("affordability_thresh")).alias("affordable_count"),
        )
    )
    is_total = F.grouping("region") == 1
    return (
        by_region.withColumn("_region", F.col("region"))
        .groupingSets(
            [["home_type", "region", "year"], ["home_type", "year"]], "home_type", "region", "year"
        )
        .agg(
            is_total.alias("_total"),
            F.min_by("affordability_thresh", "_region").alias("affordability_thresh"),
            F.sum("total_count").alias("total_count"),
            F.sum("affordable_count").alias("affordable_count"),
        )
        .withColumn("region", F.when(F.col("_total"), F.lit(total_label)).otherwise(F.col("region")))
        .withColumn("pct_affordable", percent(F.col("affordable_count"), F.col("total_count")))
        .orderBy("_total", "home_type", "region", "year")
        .drop("_total")
    )


BEDROOM_SHARES = {"pct_0br": 0, "pct_1br": 1, "pct_2br": 2, "pct_3br": 3}
TAX_CLASS_SHARES = {
    "pct_oo": "owner-occupied",
    "pct_ltr": "long-term-rental",
    "pct_noo": "non-owner-occupied",
    "pct_tvr": "tvr-strh",
}


def profile(df: DataFrame, labels: Sequence[str], label: str = "desc") -> DataFrame:
    """One row per label: size, medians, and shares of bedroom counts and tax classes.

    ``df`` has rows of these labels only. Labels without rows keep a row of size 0. A
    category that does not occur has a null share, not 0.
    """
    cells = (
        df.withColumn(
            "_positive_value",
            F.when(F.col("assessed_building_value") > 0, F.col("assessed_building_value")),
        )
        .groupBy(label, "year_built", "_positive_value", "bed_rooms", "tax_rate_class")
        .agg(F.count("*").alias("_n"))
    )

    def share(matches: Column, name: str) -> Column:
        return percent(F.sum(F.when(matches, F.col("_n"))), F.sum("_n")).alias(name)

    shares = cells.groupBy(label).agg(
        *[share(F.col("bed_rooms") == n, name) for name, n in BEDROOM_SHARES.items()],
        *[share(F.col("tax_rate_class") == c, name) for name, c in TAX_CLASS_SHARES.items()],
    )
    medians = grouped_medians(cells, [label], ["year_built", "_positive_value"], weight="_n")
    numbered = F.posexplode(F.array(*[F.lit(name) for name in labels]))
    wanted = df.sparkSession.range(1).select(numbered.alias("_position", label))
    return (
        wanted.join(medians, label, "left")
        .join(shares, label, "left")
        .orderBy("_position")
        .select(
            label,
            F.coalesce(F.col("rows"), F.lit(0)).alias("total_count"),
            F.col("year_built").cast("int").alias("median_year_built"),
            F.col("_positive_value").cast("bigint").alias("median_assessed_building_value"),
            *BEDROOM_SHARES,
            *TAX_CLASS_SHARES,
        )
    )
