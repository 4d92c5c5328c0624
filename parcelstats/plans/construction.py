"""Home construction by decade (PIPE-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstats.functions import percent
from parcelstats.operators.grid import add_decade, decade_span
from parcelstats.operators.property import parcel_dwelling_base
from parcelstats.operators.quantiles import grouped_medians
from parcelstats.reference_data import COUNTY

GROUP = ["region", "decade", "home_type"]
#: Grouping levels of the counts and medians.
REGION, COUNTY_WIDE, DECADE = 0, 1, 2


def home_construction_by_decade(assessments: DataFrame, dwellings: DataFrame) -> DataFrame:
    """Homes built per year and their areas, by home type, decade and region.

    The parcels are read once and counted per area and group; medians and year ranges of
    all levels come from these counts in one pass. What follows is one row per region, decade
    and home type, which the limits on years and the fixed regions bound: it is gathered
    into a single row and dealt out again as a dense grid, so that the plan reads it once.
    """
    homes = add_decade(parcel_dwelling_base(assessments.select("tmk", "tax_rate_class"), dwellings))
    cells = homes.groupBy(*GROUP, F.col("sf_of_living_area").alias("sqft_median")).agg(
        F.count("*").alias("_n"),
        F.min("year_built").alias("first_built"),
        F.max("year_built").alias("last_built"),
    )
    levels = grouped_medians(
        cells,
        GROUP,
        ["sqft_median"],
        [GROUP, ["decade", "home_type"], ["decade"]],
        "_n",
        lowest=["first_built"],
        highest=["last_built"],
    )
    return _with_rates(_with_all_homes(_dense_rows(levels)))


def _dense_rows(levels: DataFrame) -> DataFrame:
    """A row per region, decade and home type, counts 0 where there is none, and the county's rows.

    A null value takes part in the grid but matches no count. The county's rows are those
    there are, in no grid.
    """

    def distinct(column: str) -> Column:
        return F.collect_set(F.when(F.col("level") == REGION, F.struct(column))).alias(f"{column}s")

    def listed(level: int, *columns: str) -> Column:
        return F.collect_list(F.when(F.col("level") == level, F.struct(*columns)))

    gathered = levels.agg(
        *[distinct(c) for c in GROUP],
        listed(REGION, *GROUP, "rows", "sqft_median").alias("by_region"),
        listed(COUNTY_WIDE, "decade", "home_type", "rows", "sqft_median").alias("by_county"),
        listed(DECADE, "decade", "first_built", "last_built").alias("spans"),
    )

    def found(cells: str, **values: Column) -> Column:
        def matches(cell: Column) -> Column:
            same = F.lit(True)
            for name, value in values.items():
                same = same & (cell[name] == value)
            return F.coalesce(same, F.lit(False))

        return F.get(F.filter(cells, matches), F.lit(0))

    def cell(region: Column, decade: Column, home_type: Column, own: Column, is_county: bool) -> Column:
        return F.struct(
            region.alias("region"),
            decade.alias("decade"),
            home_type.alias("home_type"),
            own["rows"].alias("decade_count"),
            own["sqft_median"].alias("sqft_median"),
            F.lit(is_county).alias("is_county"),
        )

    def of_region(r: Column, d: Column, t: Column) -> Column:
        values = r["region"], d["decade"], t["home_type"]
        return cell(*values, found("by_region", **dict(zip(GROUP, values))), False)

    def flat(column: str, cells) -> Column:
        return F.flatten(F.transform(column, cells))

    grid = flat("regions", lambda r: flat("decades", lambda d: F.transform("home_types", lambda t: of_region(r, d, t))))
    county = F.transform("by_county", lambda c: cell(F.lit(COUNTY), c["decade"], c["home_type"], c, True))
    rows = gathered.select("by_county", "spans", F.explode(F.concat(grid, county)).alias("cell"))
    rows = rows.select("cell.*", "by_county", "spans")
    everywhere = found("by_county", decade=F.col("decade"), home_type=F.col("home_type"))
    span = found("spans", decade=F.col("decade"))
    rows = rows.withColumns({"_everywhere": everywhere, "_span": span})
    return rows.select(
        "is_county",
        *GROUP,
        *decade_span(F.col("_span.first_built"), F.col("_span.last_built")),
        F.coalesce("decade_count", F.lit(0)).alias("decade_count"),
        F.col("_everywhere.rows").alias("decade_count_all_regions"),
        "sqft_median",
        F.col("_everywhere.sqft_median").alias("sqft_median_all_regions"),
    )


def _with_all_homes(rows: DataFrame) -> DataFrame:
    """The rows, and sums over the home types; medians do not add up and stay null.

    ``_block`` numbers the regions, their sums, the county and its sums.
    """
    place = ["is_county", "region", "decade"]
    is_sum = F.grouping("home_type") == 1

    def total(column: str) -> Column:
        return F.when(is_sum, F.coalesce(F.sum(column), F.lit(0))).otherwise(F.sum(column)).alias(column)

    def single(column: str) -> Column:
        return F.when(~is_sum, F.max(column)).alias(column)

    return (
        rows.groupingSets([[*place, "home_type"], place], *place, "home_type")
        .agg(
            is_sum.alias("_sum"),
            F.max("decade_desc").alias("decade_desc"),
            F.max("num_years").alias("num_years"),
            *[total(c) for c in ("decade_count", "decade_count_all_regions")],
            *[single(c) for c in ("sqft_median", "sqft_median_all_regions")],
        )
        .withColumn("home_type", F.when(F.col("_sum"), F.lit("All Homes")).otherwise(F.col("home_type")))
        .withColumn("_block", F.col("is_county").cast("int") * 2 + F.col("_sum").cast("int"))
    )


def _with_rates(rows: DataFrame) -> DataFrame:
    def per_year(column: str) -> Column:
        return F.floor(F.try_divide(F.col(column), F.col("num_years")))

    return rows.orderBy(
        "_block",
        "home_type",
        F.col("region").asc_nulls_first(),
        "decade",
    ).select(
        "home_type",
        "decade",
        "decade_desc",
        "region",
        per_year("decade_count").alias("decade_yearly_avg"),
        per_year("decade_count_all_regions").alias("decade_yearly_avg_all_regions"),
        percent(F.col("decade_count"), F.col("decade_count_all_regions")).alias(
            "decade_region_pct"
        ),
        "sqft_median",
        "sqft_median_all_regions",
        percent(F.col("sqft_median"), F.col("sqft_median_all_regions")).alias(
            "sqft_median_region_pct"
        ),
    )
