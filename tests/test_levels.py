"""OP-6, OP-7, OP-10."""

from pyspark.sql import functions as F

from parcelstats.operators.levels import affordable_share, median_by_level, profile
from tests.helpers import rows


def test_null_region_stays_apart_from_the_total(spark):
    data = [("A", 2000, 10, 11), ("A", 2000, 13, 14), (None, 2000, 100, None), ("A", 2001, 7, 7)]
    df = spark.createDataFrame(data, "region string, year long, price long, adj_price long")
    assert rows(median_by_level(df, ["price", "adj_price"])) == [
        (None, 2000, 100, None, 1),
        ("A", 2000, 11, 12, 2),
        ("A", 2001, 7, 7, 1),
        ("Maui County", 2000, 13, 12, 3),
        ("Maui County", 2001, 7, 7, 1),
    ]


def test_total_count_is_the_sum_of_the_regions(spark):
    df = spark.range(500).select(
        F.concat(F.lit("r"), F.col("id") % 4).alias("region"),
        (2000 + F.col("id") % 3).alias("year"),
        (F.col("id") * 37 % 101).alias("price"),
    )
    result = rows(median_by_level(df, ["price"]), "region", "year", "count")
    for year in (2000, 2001, 2002):
        parts = [c for r, y, c in result if y == year and r != "Maui County"]
        assert [c for r, y, c in result if y == year and r == "Maui County"] == [sum(parts)]


def test_affordable_share(spark):
    sales = spark.createDataFrame(
        [("Condo", "B", 2000, 50), ("Condo", "B", 2000, 51), ("Condo", "A", 2000, 60), ("Condo", None, 2000, 1)],
        "home_type string, region string, year long, price long",
    )
    income = spark.createDataFrame(
        [("A", 2000, 20), ("B", 2000, 10), ("C", 2000, 5)],
        "region string, year long, median_household_income long",
    )
    assert rows(affordable_share(sales, income)) == [
        ("Condo", "A", 2000, 100, 1, 1, 100.0),
        ("Condo", "B", 2000, 50, 2, 1, 50.0),
        ("Condo", "Maui County", 2000, 100, 3, 2, 66.7),
    ]


def test_profile_has_null_for_absent_categories_and_a_row_for_empty_labels(spark):
    df = spark.createDataFrame(
        [("x", 1990, 0, 1, "tvr-strh"), ("x", 1991, 500, 1, "tvr-strh"), ("x", None, 601, 4, None)],
        "desc string, year_built long, assessed_building_value long, bed_rooms long, tax_rate_class string",
    )
    found = profile(df, ["y", "x"])
    assert found.columns == [
        "desc", "total_count", "median_year_built", "median_assessed_building_value",
        "pct_0br", "pct_1br", "pct_2br", "pct_3br", "pct_oo", "pct_ltr", "pct_noo", "pct_tvr",
    ]
    assert rows(found) == [
        ("y", 0, *[None] * 10),
        ("x", 3, 1990, 550, None, 66.7, None, None, None, None, None, 66.7),
    ]
