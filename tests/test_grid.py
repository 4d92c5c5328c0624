"""OP-14, OP-15."""

from pyspark.sql import functions as F

from parcelstats.operators import grid
from parcelstats.operators.grid import add_decade, decade_bins, dense_counts
from tests.helpers import bag, plan, rows

SCHEMA = "region string, decade long, home_type string, n long, m double"


def test_missing_combinations_and_the_null_region_are_zero(spark):
    counts = spark.createDataFrame(
        [("A", 1970, "Condo", 3, 1.5), (None, 1980, "House", 2, 2.5)], SCHEMA
    )
    found = dense_counts(counts, ["region", "decade", "home_type"], "n")
    assert bag(found, "region", "decade", "home_type", "n", "m") == [
        (None, 1970, "Condo", 0, None),
        (None, 1970, "House", 0, None),
        (None, 1980, "Condo", 0, None),
        (None, 1980, "House", 0, None),
        ("A", 1970, "Condo", 3, 1.5),
        ("A", 1970, "House", 0, None),
        ("A", 1980, "Condo", 0, None),
        ("A", 1980, "House", 0, None),
    ]
    text = plan(found)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_values_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "BLOCK", 2)
    counts = spark.createDataFrame([("A", d, f"x{d % 3}", 1, 1.0) for d in range(7)], SCHEMA)
    found = rows(dense_counts(counts, ["region", "decade", "home_type"], "n"), "decade", "home_type", "n")
    assert sorted(found) == [(d, f"x{h}", int(d % 3 == h)) for d in range(7) for h in range(3)]


def test_few_blocks_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(grid, "TASK_ROWS", 1000)
    counts = spark.range(5000).selectExpr("id AS region", "id % 50 AS decade", "'x' AS home_type", "id AS n", "1d AS m")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        n_rows, n_values = F.lit(5000), F.lit(50)
        found = grid.with_each_value(counts.select("region"), counts.select("decade").distinct(), n_rows, n_values)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        dense = dense_counts(counts, ["region", "decade", "home_type"], "n")
        assert dense.count() == 250_000 and dense.agg(F.sum("n")).first()[0] == 4999 * 2500
    finally:
        for name in settings:
            spark.conf.unset(name)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 250_000 and len(sizes) == parts and max(sizes) < 2 * 250_000 / parts


def test_decades(spark):
    df = spark.createDataFrame([(y,) for y in [1969, 1970, 1974, 1979, 1995, 2023, 2024, None]], "year_built long")
    found = add_decade(df)
    assert bag(found) == [(1970, 1970), (1974, 1970), (1979, 1970), (1995, 1990), (2023, 2020)]
    assert bag(decade_bins(found)) == [
        (1970, "1970-1979", 10), (1990, "1995-1995", 1), (2020, "2023-2023", 1),
    ]
