"""The registered queries: name -> function of (spark, sf_dir)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import raw_lines
from checks.fixtures import Inputs
from parcelstats.operators.census import tract_income
from parcelstats.operators.geo import (
    add_complex_code,
    add_tract_region,
    add_zone_region,
    mark_special_complexes,
)
from parcelstats.operators.grid import dense_counts
from parcelstats.operators.inflation import adjust_for_inflation, deflate_to_nominal
from parcelstats.operators.keys import dedupe_bundle_sales, first_per_key, valid_parcel_key
from parcelstats.operators.levels import median_by_level
from parcelstats.operators.property import (
    add_price_per_sqft,
    add_resident_type,
    main_dwellings,
    owner_rollup,
    parcel_dwelling_base,
    parcel_enriched,
    sale_normalise,
)
from parcelstats.operators.quantiles import grouped_medians, weighted_median
from parcelstats.operators.series import interpolate_by_reference
from parcelstats.plans import affordability, condo, construction, income, sales
from parcelstats.plans.ingest import ingest
from parcelstats.reference_data import PROPERTY_BASE_YEAR
from parcelstats.sources.csv import read_csv, write_csv
from parcelstats.sources.extracts import read_extract
from parcelstats.sources.fixed_width import (
    parse_assessments,
    parse_dwellings,
    parse_owners,
    parse_sales,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder of the cluster; local only on one machine without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return f"{shared or tempfile.gettempdir()}/parcelstats-{uuid.uuid4().hex}"


@query
def median_sales_sfh(i: Inputs) -> DataFrame:
    return sales.single_family_home_sales(i.assessments(), i.dwellings(), i.sales(), i.cpi())


@query
def median_sales_condo(i: Inputs) -> DataFrame:
    return sales.condo_sales(i.assessments(), i.dwellings(), i.sales(), i.cpi())


@query
def affordable_sales(i: Inputs) -> DataFrame:
    return affordability.affordable_sales(
        i.assessments(), i.dwellings(), i.sales(), household_income_interpolated(i)
    )


@query
def construction_by_decade(i: Inputs) -> DataFrame:
    return construction.home_construction_by_decade(i.assessments(), i.dwellings())


@query
def condo_profile(i: Inputs) -> DataFrame:
    return condo.condo_characteristics(i.assessments(), i.dwellings(), i.special_complexes())


@query
def household_income(i: Inputs) -> DataFrame:
    return income.household_income(
        i.tract_income(), i.county_income(), i.tract_population(), i.cpi()
    )


@query
def household_income_interpolated(i: Inputs) -> DataFrame:
    return income.household_income_interpolated(
        i.tract_income(),
        i.county_income(),
        i.tract_population(),
        i.cpi(),
        i.state_reference(),
        i.county_reference(),
    )


@query
def price_to_income(i: Inputs) -> DataFrame:
    return affordability.property_affordability(
        median_sales_sfh(i), household_income_interpolated(i)
    )


@query
def fixed_width_assessments(i: Inputs) -> DataFrame:
    return parse_assessments(raw_lines.assessment_lines(i))


@query
def fixed_width_dwellings(i: Inputs) -> DataFrame:
    return parse_dwellings(raw_lines.dwelling_lines(i))


@query
def fixed_width_owners(i: Inputs) -> DataFrame:
    return parse_owners(raw_lines.owner_lines(i))


@query
def fixed_width_sales(i: Inputs) -> DataFrame:
    return parse_sales(raw_lines.sales_lines(i), raw_lines.sales_header())


@query
def valid_parcel_keys(i: Inputs) -> DataFrame:
    return valid_parcel_key(i.assessments())


@query
def first_rows_per_key(i: Inputs) -> DataFrame:
    parcels = i.assessments()
    return first_per_key(parcels, ["tmk"], [c for c in parcels.columns if c != "tmk"])


@query
def largest_per_key(i: Inputs) -> DataFrame:
    return main_dwellings(i.dwellings())


@query
def bundle_dedupe(i: Inputs) -> DataFrame:
    return dedupe_bundle_sales(sale_normalise(i.sales()))


def _amounts(i: Inputs) -> DataFrame:
    return i.table("orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.floor("o_totalprice").alias("amount"),
    )


@query
def inflation_adjust(i: Inputs) -> DataFrame:
    return adjust_for_inflation(_amounts(i), i.cpi(), "amount", PROPERTY_BASE_YEAR)


@query
def inflation_roundtrip(i: Inputs) -> DataFrame:
    return deflate_to_nominal(
        inflation_adjust(i).drop("amount"), i.cpi(), "amount", PROPERTY_BASE_YEAR
    )


@query
def zone_region(i: Inputs) -> DataFrame:
    return add_zone_region(valid_parcel_key(i.assessments()).select("tmk"))


@query
def tract_region(i: Inputs) -> DataFrame:
    return add_tract_region(tract_income(i.tract_income()))


@query
def weighted_median_generic(i: Inputs) -> DataFrame:
    lines = i.table("lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.col("l_extendedprice").alias("price"),
        "l_quantity",
    )
    return weighted_median(lines, ["flag", "year"], "price", "l_quantity")


@query
def median_generic(i: Inputs) -> DataFrame:
    lines = i.table("lineitem").select(
        F.col("l_returnflag").alias("flag"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    return median_by_level(lines, ["price", "quantity"], "flag", "year", total_label="all")


@query
def median_of_times(i: Inputs) -> DataFrame:
    """Median time of the events per type, in microseconds, in ranges of few values."""
    times = i.table("events").select("event_type", F.expr("unix_micros(cast(ts AS TIMESTAMP))").alias("micros"))
    medians = grouped_medians(times, ["event_type"], ["micros"], [["event_type"], []], cut=50)
    kind = F.when(F.col("level") == 1, F.lit("all")).otherwise(F.col("event_type"))
    return medians.select(kind.alias("event_type"), F.col("micros").cast("bigint").alias("micros"), "rows")


@query
def weighted_median_of_times(i: Inputs) -> DataFrame:
    """Median time weighted by a fraction, where one group holds a third of the rows and more."""
    user = F.col("user_id")
    times = i.table("events").select(
        F.when(user % 3 == 0, F.lit("hot")).otherwise((user % 5).cast("string")).alias("users"),
        F.expr("unix_micros(cast(ts AS TIMESTAMP))").alias("micros"),
        ((user % 8) / 8).alias("weight"),
    )
    return weighted_median(times, ["users"], "micros", "weight", cut=50)


@query
def interpolate_segments(i: Inputs) -> DataFrame:
    """As ``interpolate_generic``, in segments of few hours."""
    known, reference = _hourly(i)
    return interpolate_by_reference(
        known, reference, "mean", group="event_type", position="hour", segment=20
    )


def _hourly(i: Inputs) -> tuple[DataFrame, DataFrame]:
    points = i.table("events").select(
        F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("hour"),
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    mean = F.expr("sum(cents) * 100 div count(*)").alias("mean")
    return points.groupBy("hour", "event_type").agg(mean), points.groupBy("hour").agg(mean)


@query
def interpolate_generic(i: Inputs) -> DataFrame:
    """Hourly means per event type, filled along the hourly mean of all types."""
    known, reference = _hourly(i)
    return interpolate_by_reference(known, reference, "mean", group="event_type", position="hour")


@query
def dense_grid_generic(i: Inputs) -> DataFrame:
    orders = i.table("orders").join(
        i.table("customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    counts = (
        orders.join(i.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.col("n_name").alias("nation"),
            F.col("o_orderpriority").alias("priority"),
            F.year("o_orderdate").cast("bigint").alias("year"),
        )
        .agg(F.count("*").alias("orders"))
    )
    return dense_counts(counts, ["nation", "priority", "year"], "orders")


@query
def owners_per_parcel(i: Inputs) -> DataFrame:
    return owner_rollup(i.owners())


@query
def ppsf_resident(i: Inputs) -> DataFrame:
    base = parcel_dwelling_base(i.assessments(), i.dwellings())
    return add_resident_type(add_price_per_sqft(base)).select(
        "tmk",
        "tax_rate_class",
        "sf_of_living_area",
        "assessed_building_value",
        "ppsf",
        "resident_type",
    )


@query
def parcels_enriched(i: Inputs) -> DataFrame:
    flags = [
        "is_lahaina", "is_west_maui", "is_central_maui", "is_upcountry", "is_south_maui",
        "is_east_maui", "is_molokai", "is_lanai",
    ]
    enriched = parcel_enriched(
        i.assessments(), i.prior_assessments(), i.dwellings(), i.owners()
    )
    return enriched.drop(*flags)


@query
def csv_normalised_roundtrip(i: Inputs) -> DataFrame:
    """Writes CSV with awkward column names into a new folder and reads it back."""
    orders = i.table("orders").select(
        F.col("o_orderkey").alias(" Order Key"),
        F.col("o_orderstatus").alias("Order/Status "),
        F.col("o_totalprice").alias("Total / Price (USD)"),
        F.col("o_orderpriority").alias("PRIORITY"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Order Date"),
        F.col("o_custkey").alias("not wanted"),
    )
    folder = scratch_folder(i.spark)
    write_csv(orders, folder)
    types = {"order_key": "bigint", "total_price_(usd)": "double"}
    wanted = ["order_key", "order_status", "total_price_(usd)", "priority", "order_date", "missing"]
    return read_csv(i.spark, folder, wanted, types)


#: Lines of a compressed raw file, which one task reads from beginning to end.
LINES_OF_A_FILE = 500_000


def ingested(i: Inputs, kind: str, lines: DataFrame, strategy: str = "DEFAULT_STRATEGY") -> DataFrame:
    """Raw lines written as compressed text files, turned into a typed table and read from there."""
    folder = scratch_folder(i.spark)
    options = {"maxRecordsPerFile": LINES_OF_A_FILE, "zlib.compress.strategy": strategy}
    lines.write.options(**options).text(f"{folder}/raw", compression="gzip")
    ingest(i.spark, kind, f"{folder}/raw", f"{folder}/table")
    return i.spark.read.parquet(f"{folder}/table")


@query
def ingest_assessments(i: Inputs) -> DataFrame:
    return ingested(i, "assessments", raw_lines.assessment_lines(i))


@query
def ingest_dwellings(i: Inputs) -> DataFrame:
    """Lines of digits and blanks: codes by frequency alone make less than half of them, whatever the numbers
    are, and take a fraction of the time that a search for repeats does."""
    return ingested(i, "dwellings", raw_lines.dwelling_lines(i), "HUFFMAN_ONLY")


@query
def ingest_owners(i: Inputs) -> DataFrame:
    return ingested(i, "owners", raw_lines.owner_lines(i))


@query
def ingest_sales(i: Inputs) -> DataFrame:
    """The file begins with the header; its copies and other noise lie between the data."""
    header = i.spark.range(1).select(F.lit(raw_lines.sales_header()).alias("value"))
    return ingested(i, "sales", header.union(raw_lines.sales_lines(i)))


@query
def csv_files_by_name(i: Inputs) -> DataFrame:
    """Files with columns in another order, read by a pattern; ragged lines and bad values."""
    folder = scratch_folder(i.spark)
    orders = {
        "1995": ["Order Key", "Total / Price", "Order Date", "Priority"],
        "1996": ["Priority", "Order Key", "Extra", "Order Date", "Total / Price"],
    }
    for name, columns in orders.items():
        raw_lines.csv_lines(i, columns).write.text(f"{folder}/orders-{name}")
    wanted = ["order_key", "total_price", "order_date", "priority"]
    types = {"order_key": "bigint", "total_price": "bigint"}
    return read_csv(i.spark, f"{folder}/orders-*", wanted, types, by_name=True)


def extract(i: Inputs, name: str, rows: DataFrame) -> DataFrame:
    """Rows written as CSV and read as the extract of that name."""
    folder = scratch_folder(i.spark)
    write_csv(rows, folder)
    return read_extract(i.spark, name, folder)


@query
def price_to_income_from_files(i: Inputs) -> DataFrame:
    """The ratio from the published files of the two statistics."""
    return affordability.property_affordability(
        extract(i, "property_sales", median_sales_sfh(i)),
        extract(i, "household_income", household_income_interpolated(i)),
    )


@query
def affordable_sales_from_files(i: Inputs) -> DataFrame:
    """Affordable sales with all inputs read from CSV files."""
    return affordability.affordable_sales(
        extract(i, "assessments", i.assessments()),
        extract(i, "dwellings", i.dwellings()),
        extract(i, "sales", i.sales()),
        extract(i, "household_income", household_income_interpolated(i)),
    )


@query
def condo_profile_built_in(i: Inputs) -> DataFrame:
    """Condominium subsets with the built-in complexes, on parcels that lie in them."""
    moved = [i.in_built_in_complexes(t) for t in (i.assessments(), i.dwellings())]
    return condo.condo_characteristics(*moved)


@query
def complex_names(i: Inputs) -> DataFrame:
    """Parcels with the name of their complex, where it is one of the built-in ones."""
    parcels = valid_parcel_key(i.in_built_in_complexes(i.assessments()).select("tmk").distinct())
    return mark_special_complexes(add_complex_code(parcels)).select("tmk", "is_special", "complex_name")


# Names of the survey where a function of that name is already in use.
for name, build in {
    "valid_parcel_key": "valid_parcel_keys",
    "first_per_key": "first_rows_per_key",
    "owner_rollup": "owners_per_parcel",
    "parcel_enriched": "parcels_enriched",
}.items():
    QUERIES[name] = QUERIES.pop(build)
