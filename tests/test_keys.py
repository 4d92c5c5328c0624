"""OP-2, OP-3, OP-4, OP-18 and the skew-proof join."""

import pytest
from pyspark.sql import functions as F

from parcelstats.operators.keys import (
    dedupe_bundle_sales,
    first_per_key,
    largest_per_key,
    valid_parcel_key,
)
from parcelstats.operators.skew import hot_keys, join_spread
from tests.helpers import bag, plan

BUNDLE = "saledate string, price long, recorddate string, instruno string, landcourt_no string, cert_no string"


def test_valid_parcel_key_casts_leniently_and_counts_characters(spark):
    keys = ["2110010010001", "0", "abc", None, "21100100100011", " 2110010010002 ", "-211001001000"]
    df = spark.createDataFrame([(k,) for k in keys], "tmk string")
    assert bag(valid_parcel_key(df)) == [(-211001001000,), (2110010010001,), (2110010010002,)]


def test_valid_parcel_key_reaches_the_parquet_scan(spark, tmp_path):
    spark.range(10).withColumnRenamed("id", "tmk").write.parquet(f"{tmp_path}/t")
    text = plan(valid_parcel_key(spark.read.parquet(f"{tmp_path}/t")))
    assert "PushedFilters: [Or(" in text


def test_first_per_key_takes_whole_rows_and_keeps_the_null_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, None), (None, 5, "n"), (None, 4, "m")], "k string, o int, v string"
    )
    assert bag(first_per_key(df, ["k"], ["o"])) == [(None, 4, "m"), ("a", 1, None)]
    # The rank limit also runs ahead of the exchange.
    assert plan(first_per_key(df, ["k"], ["o"])).count("WindowGroupLimit") == 2


def test_largest_per_key_prefers_nulls_by_default(spark):
    df = spark.createDataFrame(
        [(1, 500, 1990), (1, None, 1980), (2, 300, 2000), (2, 300, 1999)], "tmk long, area long, y int"
    )
    assert bag(largest_per_key(df, ["tmk"], "area", ["y"])) == [(1, None, 1980), (2, 300, 1999)]
    largest = largest_per_key(df, ["tmk"], "area", ["y"], nulls_first=False)
    assert bag(largest) == [(1, 500, 1990), (2, 300, 1999)]


def test_bundle_keeps_the_lowest_parcel_and_null_fields_group_together(spark):
    bundle = ("2001-01-01", 100, None, "i", None, "c")
    other = ("2001-01-01", 101, None, "i", None, "c")
    df = spark.createDataFrame(
        [(3, "r3", *bundle), (2, None, *bundle), (2, None, *bundle), (9, "r9", *other)],
        f"tmk long, region string, {BUNDLE}",
    )
    result = dedupe_bundle_sales(df)
    assert result.columns == df.columns
    assert bag(result, "tmk", "region") == [(2, None), (9, "r9")]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows", [0, 3, 1000])
def test_join_spread_equals_a_plain_join(spark, how, hot_rows):
    # One key holds a third of the rows, half of these are copies of one row.
    hot = [(7, i // 40) for i in range(80)]
    rest = [(i % 20 + 10, i) for i in range(160)] + [(None, 1)]
    facts = spark.createDataFrame(hot + rest, "k long, v long").repartition(5)
    unique = spark.createDataFrame([(k, f"u{k}") for k in [7, *range(10, 25), 99]], "k long, u string")
    found = join_spread(facts, unique, "k", hot_keys(facts, "k", hot_rows), how, slices=4)
    assert bag(found, "k", "v", "u") == bag(facts.join(unique, "k", how), "k", "v", "u")


def test_hot_rows_are_spread_over_slices(spark):
    facts = spark.createDataFrame([(7, 0)] * 400, "k long, v long").repartition(8)
    unique = spark.createDataFrame([(7, "u")], "k long, u string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_spread(facts, unique, "k", hot_keys(facts, "k", 10), slices=8)
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(row["count"] for row in parts) == 400


def test_join_spread_rejects_other_join_types(spark):
    df = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(ValueError):
        join_spread(df, df, "k", df, "full")
