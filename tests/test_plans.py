"""PIPE-5..11 on small hand-made extracts, and all registered queries against SQL."""

import inspect
import pathlib

import pytest

import __spark_entry__
from checks.oracle import oracle_sql
from checks.queries import QUERIES
from parcelstats import plans
from parcelstats.plans import affordability, condo, construction, income, sales
from tests.compare import differences, duckdb_on
from tests.helpers import bag, plan, rows

SMALL = "/root/testdata/sf0.001"
SQL = oracle_sql()
WEST, LANAI = 2450010010000, 2490010010000


@pytest.fixture(scope="module")
def database():
    return duckdb_on(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    assert differences(QUERIES[name](spark, SMALL), database, SQL[name]) == []


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.fixture(scope="module")
def market(spark):
    """Houses in the west, condominiums on Lanai; two parcels of each."""
    assessments = spark.createDataFrame(
        [(WEST + i, "owner-occupied", 1000 * i, 1, 1) for i in (1, 2)]
        + [(LANAI + i, "tvr-strh", 500, 1, 1) for i in (1, 2)],
        "tmk long, tax_rate_class string, assessed_building_value long, assessed_land_value long,"
        " building_exemption long",
    )
    dwellings = spark.createDataFrame(
        [(WEST + 1, 1000, 1971, 3, 0), (WEST + 2, 1200, 1979, 3, 0), (LANAI + 1, 600, 1985, 1, 1),
         (LANAI + 2, 650, 2023, 0, 1)],
        "tmk long, sf_of_living_area long, year_built long, bed_rooms long, condo_type long",
    )
    west, lanai = WEST - 2 * 10**12, LANAI - 2 * 10**12
    sold = spark.createDataFrame(
        [
            (west + 1, "2000-02-01", "2000-03-01", 100_000, "1", None, None),
            (west + 2, "2000-02-01", "2000-03-01", 100_000, "1", None, None),
            (west + 2, "2000-05-01", "2000-05-01", 200_001, "2", None, None),
            (lanai + 1, "1900-01-01", "2001-01-01", 50_000, "3", None, None),
        ],
        "parid long, saledate string, recorddate string, price long, instruno string, landcourt_no string,"
        " cert_no string",
    )
    cpi = spark.createDataFrame([(2000, 100.0), (2001, 200.0), (2020, 300.0), (2023, 400.0)], "year long, cpi double")
    return assessments, dwellings, sold, cpi


def test_median_sales(market):
    assert rows(sales.single_family_home_sales(*market)) == [
        ("West Maui", 2000, 150_000, 600_002, 2),
        ("Maui County", 2000, 150_000, 600_002, 2),
    ]
    assert rows(sales.condo_sales(*market)) == [
        ("Lanai", 2001, 50_000, 100_000, 1),
        ("Maui County", 2001, 50_000, 100_000, 1),
    ]


def test_sales_are_the_same_with_every_key_hot(market):
    assessments, dwellings, sold, _ = market
    usual = sales.residential_sales(assessments, dwellings, sold)
    spread = sales.residential_sales(assessments, dwellings, sold, hot_rows=0)
    assert bag(usual, "tmk", "price", "year") == bag(spread, "tmk", "price", "year")
    assert usual.count() == 3


def test_affordable_sales_and_ratio(spark, market):
    assessments, dwellings, sold, cpi = market
    incomes = spark.createDataFrame(
        [(2000, "West Maui", 80_000, 20_000), (2001, "Lanai", 1, 9_999)],
        "year long, region string, adj_median_household_income long, median_household_income long",
    )
    assert rows(affordability.affordable_sales(assessments, dwellings, sold, incomes)) == [
        ("Condo", "Lanai", 2001, 49_995, 1, 0, 0.0),
        ("Single Family Home", "West Maui", 2000, 100_000, 2, 1, 50.0),
        ("Condo", "Maui County", 2001, 49_995, 1, 0, 0.0),
        ("Single Family Home", "Maui County", 2000, 100_000, 2, 1, 50.0),
    ]
    medians = sales.single_family_home_sales(assessments, dwellings, sold, cpi)
    assert rows(affordability.property_affordability(medians, incomes)) == [
        ("West Maui", 2000, 7.5, 600_002, 80_000)
    ]


def test_construction(market):
    assessments, dwellings, *_ = market
    found = construction.home_construction_by_decade(assessments, dwellings)
    table = rows(found, "home_type", "decade_desc", "region", "decade_yearly_avg", "decade_region_pct", "sqft_median")
    assert table[:6] == [
        ("Condo", "1971-1979", "Lanai", 0, None, None),
        ("Condo", "1985-1985", "Lanai", 1, 100.0, 600.0),
        ("Condo", "2023-2023", "Lanai", 1, 100.0, 650.0),
        ("Condo", "1971-1979", "West Maui", 0, None, None),
        ("Condo", "1985-1985", "West Maui", 0, 0.0, None),
        ("Condo", "2023-2023", "West Maui", 0, 0.0, None),
    ]
    assert table[-3:] == [
        ("All Homes", "1971-1979", "Maui County", 0, 100.0, None),
        ("All Homes", "1985-1985", "Maui County", 1, 100.0, None),
        ("All Homes", "2023-2023", "Maui County", 1, 100.0, None),
    ]
    # Two home types, three decades, two regions; all homes; county; county all homes.
    assert len(table) == 12 + 6 + 3 + 3


def test_condo_characteristics_with_the_built_in_complexes(spark, market):
    south = 2390010020000
    assessments = spark.createDataFrame(
        [(south + 1, "tvr-strh", 100), (south + 2, "owner-occupied", 301), (WEST + 1, "owner-occupied", 7)],
        "tmk long, tax_rate_class string, assessed_building_value long",
    )
    dwellings = spark.createDataFrame(
        [(south + 1, 500, 1980, 1, 1), (south + 2, 500, 1981, 2, 1), (WEST + 1, 500, 1990, 1, 2)],
        "tmk long, sf_of_living_area long, year_built long, bed_rooms long, condo_type long",
    )
    assert rows(condo.condo_characteristics(assessments, dwellings)) == [
        ("west-south-maui-minatoya-condos", 2, 1980, 200, None, 50.0, 50.0, None, 50.0, None, None, 50.0),
        ("west-south-maui-non-minatoya-condos", 1, 1990, 7, None, 100.0, None, None, 100.0, None, None, None),
        ("central-maui-condos", 0, *[None] * 10),
    ]


@pytest.fixture(scope="module")
def census(spark):
    tracts = spark.createDataFrame(
        [("2000", "Hawaii", 31400, "10"), ("2000", "Hawaii", 31500, "30"), ("2000", "Alaska", 31400, "99"),
         ("1990", "Hawaii", 31600, "5"), ("1980", "Hawaii", 31600, "5"), ("2011-2015", "Hawaii", 31400, "70"),
         ("2000", "Hawaii", 39900, "1"), ("Year", "State", None, "Median")],
        "year string, state string, tracta long, b79aa string",
    )
    county = spark.createDataFrame(
        [("2000", "Hawaii", "Maui County", "20"), ("2000", "Hawaii", "Kauai County", "21")],
        "year string, state string, county string, b79aa string",
    )
    population = spark.createDataFrame(
        [("2000", "Hawaii", 31400, 9), ("2000", "Hawaii", 31500, 1), ("1990", "Hawaii", 31600, 5),
         ("1980", "Hawaii", 31600, 5)],
        "year string, state string, tracta long, av0aa int",
    )
    cpi = spark.createDataFrame(
        [(y, 100.0) for y in (1980, 1990, 1999)] + [(y, 50.0) for y in (2000, 2001, 2015, 2020)] + [(2023, 200.0)],
        "year long, cpi double",
    )
    return tracts, county, population, cpi


def test_household_income(census):
    # 1980 lacks Lanai by rule, 2015 has no population.
    assert rows(income.household_income(*census)) == [
        (1990, "Lanai", 3, 6),
        (2000, "West Maui", 30, 30),
        (2000, "Maui County", 20, 20),
    ]


def test_household_income_interpolated(spark, census):
    state = spark.createDataFrame(
        [("1989-01-01", "9"), ("1990-01-01", "100"), ("1999-01-01", "100"), ("2000-01-01", "999")],
        "observation_date string, median_household_income string",
    )
    county = spark.createDataFrame(
        [("1999-01-01", "7"), ("2000-01-01", "100"), ("2001-01-01", ".")],
        "observation_date string, median_household_income string",
    )
    found = income.household_income_interpolated(*census, state, county)
    assert found.columns == ["year", "region", "adj_median_household_income", "median_household_income"]
    assert rows(found) == [
        # 1989 and 2001 have no reference value: rows without income.
        *[(1990, "Lanai", 10, 5), (1999, "Lanai", 10, 5), (2000, "Lanai", 20, 5), (2001, "Lanai", None, None)],
        *[(1989, "West Maui", None, None), (1990, "West Maui", 60, 30), (1999, "West Maui", 60, 30)],
        *[(2000, "West Maui", 120, 30), (2001, "West Maui", None, None)],
        *[(1989, "Maui County", None, None), (1990, "Maui County", 40, 20), (1999, "Maui County", 40, 20)],
        *[(2000, "Maui County", 80, 20), (2001, "Maui County", None, None)],
    ]


#: Queries that write files first and read them.
ON_FILES = {n for n in QUERIES if n.startswith(("csv_", "ingest_")) or n.endswith("_files")}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ON_FILES))
def test_building_a_statistic_starts_no_job(spark, name):
    QUERIES[name](spark, SMALL)  # reads the schemas of the tables
    spark.sparkContext.setJobGroup(f"build {name}", "")
    try:
        QUERIES[name](spark, SMALL)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")
    # A table's schema is read by a job of one task.
    assert len(jobs) <= sum(1 for _ in pathlib.Path(SMALL).glob("*.parquet"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"csv_normalised_roundtrip"}))
def test_plans_stay_on_the_jvm_and_have_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_the_library_does_not_collect():
    allowed = {"sources/fixed_width.py"}  # the header line of a sales file
    root = pathlib.Path(inspect.getfile(plans)).parent.parent
    for path in root.rglob("*.py"):
        if path.relative_to(root).parts[0] == "llm":  # has tests of its own
            continue
        source = path.read_text()
        for call in (".collect(", ".toPandas(", ".rdd", "udf(", "crossJoin", "localCheckpoint", ".head("):
            if str(path.relative_to(root)) not in allowed:
                assert call not in source, (path, call)
