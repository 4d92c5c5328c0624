"""Exact medians (AGG-4) and weighted medians (OP-11) against brute force."""

import math
import re
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelstats.operators import quantiles
from parcelstats.operators.quantiles import grouped_medians, range_number, weighted_median
from tests.helpers import bag, plan, rows

FEW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
NUMBERS = st.one_of(
    st.none(),
    st.integers(-50, 50),
    st.integers(-(10**12), 10**12),
    st.sampled_from([0, 0, 1, 350_000, 350_001, 10**9, 10**9 + 1]),
)


def median(values):
    known = [v for v in values if v is not None]
    return float(statistics.median(known)) if known else None


@FEW
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), NUMBERS, NUMBERS), min_size=1, max_size=40))
def test_medians_per_level_match_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, x long, y long").withColumn("p", F.lit(1))
    depth = len(data) % 2 + 1
    found = grouped_medians(df, ["k", "p"], ["x", "y"], [["k", "p"], ["p"]], cut=len(data) % 5, depth=depth)
    expected = [
        (k, 1, 0, median([r[1] for r in data if r[0] == k]), median([r[2] for r in data if r[0] == k]),
         sum(r[0] == k for r in data))
        for k in {r[0] for r in data}
    ]
    expected.append((None, 1, 1, median([r[1] for r in data]), median([r[2] for r in data]), len(data)))
    order = lambda r: (r[2], r[0] is not None, str(r[0]))
    result = rows(found, "k", "p", "level", "x", "y", "rows")
    assert sorted(result, key=order) == sorted(expected, key=order)


def test_median_of_counted_values(spark):
    df = spark.createDataFrame([(1.5, 3), (2.5, 1), (9.0, 2)], "v double, n long")
    assert rows(grouped_medians(df, [], ["v"], [[]], "n"), "v", "rows") == [(2.0, 6)]


def test_a_hot_group_is_spread_over_its_values(spark):
    df = spark.range(50_000).select(F.lit("hot").alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"))
    found = grouped_medians(df, ["k"], ["v"], cut=1000)
    values = sorted(r[0] for r in df.select("v").collect())
    assert rows(found, "v") == [((values[24_999] + values[25_000]) / 2,)]
    # Values are exchanged by group and value, and sorted only within a range.
    text = plan(found)
    assert "hashpartitioning(k" in text and "percentile(" not in text


def test_ranges_follow_the_order_of_the_values(spark):
    values = [None, float("-inf"), -1e300, -12.5, -1.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 2.0, 1e18, 1e300,
              float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "_value double").withColumn("k", F.lit(1))
    ranged = quantiles._with_ranges(df, ["k"], "n", 5)
    numbers = dict((str(v), n) for v, n in ranged.select("_value", "n").collect())
    assert numbers["None"] is None
    in_order = [numbers[str(v)] for v in values[1:]]
    assert in_order == sorted(in_order) and len(set(in_order)) > 10
    undivided = quantiles._with_ranges(df, ["k"], "n", 14)
    assert {n for v, n in undivided.select("_value", "n").collect() if v is not None} == {0}


@pytest.mark.parametrize("shape", ["close", "skewed"])
def test_ranges_hold_about_equally_many_values(spark, shape):
    # Microseconds of one second, and values that crowd together near nought.
    n = 50_000
    value = F.col("id") * 331 + 1_700_000_000_000_000 if shape == "close" else F.exp(F.col("id") / 500.0)
    df = spark.range(n).select(F.lit("k").alias("k"), value.cast("double").alias("_value"))
    ranged = quantiles._with_ranges(df, ["k"], "n", 1000)
    sizes = [r["count"] for r in ranged.groupBy("n").count().collect()]
    ranges = quantiles.SPLITS**2
    assert len(sizes) > 0.8 * ranges and max(sizes) < 4 * n / ranges


@pytest.mark.parametrize("depth", [1, 2])
def test_close_large_values(spark, depth):
    start = 1_700_000_000_000_000
    df = spark.range(3001).select(F.lit("k").alias("k"), (F.col("id") * 331 + start).alias("v"), F.lit(1).alias("w"))
    for cut in (1, 1000):
        found = grouped_medians(df, ["k"], ["v"], cut=cut, depth=depth)
        assert rows(found, "v") == [(float(start + 1500 * 331),)]
        weighted = weighted_median(df, ["k"], "v", "w", cut=cut, depth=depth)
        assert rows(weighted, "v") == [(start + 1500 * 331,)]


def reference_weighted_median(data):
    """Row by row, as the rule is stated."""
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))
    total = sum(w for _, w in data if w is not None)
    running = 0
    for value, weight in ordered:
        if weight is None:
            continue
        running += weight
        if total and (running - weight / 2) / total >= 0.5:
            return [value]
    return []


@FEW
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 6), st.integers(0, 10**6)),
                  st.one_of(st.none(), st.integers(0, 9))),
        min_size=1, max_size=25,
    )
)
def test_weighted_median_matches_the_row_by_row_rule(spark, data):
    df = spark.createDataFrame(data, "v long, w long").withColumn("k", F.lit(None).cast("string"))
    found = weighted_median(df, ["k"], "v", "w", cut=len(data) % 4, depth=len(data) % 2 + 1)
    assert [r[0] for r in rows(found, "v")] == reference_weighted_median(data)


def test_weighted_median_is_not_the_textbook_rule(spark):
    # Position of the first value is 0.45, so that the second one is chosen.
    df = spark.createDataFrame([("a", 10, 9), ("a", 20, 1)], "k string, v long, w long")
    assert rows(weighted_median(df, ["k"], "v", "w")) == [("a", 20)]


def test_fractional_weights_with_a_group_of_a_third_of_the_rows(spark):
    data = [("hot" if i % 3 == 0 else f"g{i % 40}", (i * 7919) % 100_003, (i % 7) / 8) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v long, w double")
    expected = [(k, *reference_weighted_median([(v, w) for g, v, w in data if g == k])) for k in {r[0] for r in data}]
    for cut in (10, 500):
        assert bag(weighted_median(df, ["k"], "v", "w", cut=cut)) == sorted(expected)
    whole = reference_weighted_median([(v, w) for _, v, w in data])
    assert rows(weighted_median(df, [], "v", "w", cut=100)) == [tuple(whole)]


def test_groups_without_weight_give_no_row(spark):
    df = spark.createDataFrame([("a", 10, None), ("b", 5, 0), ("c", 1, 2)], "k string, v long, w long")
    assert rows(weighted_median(df, ["k"], "v", "w")) == [("c", 1)]


@pytest.mark.parametrize("parts", [1, 17])
def test_results_do_not_depend_on_the_partitioning(spark, parts):
    data = [(i % 3, (i * 7919) % 1000, i % 11) for i in range(600)]
    df = spark.createDataFrame(data, "k long, v long, w long").repartition(parts)
    medians = bag(grouped_medians(df, ["k"], ["v"]), "k", "v")
    assert medians == [(k, median([r[1] for r in data if r[0] == k])) for k in range(3)]
    weighted = bag(weighted_median(df, ["k"], "v", "w"))
    assert weighted == [
        (k, *reference_weighted_median([(v, w) for g, v, w in data if g == k])) for k in range(3)
    ]
    assert not math.isnan(medians[0][1])


def test_a_divided_group_is_not_counted_per_value(spark):
    n = 40_000
    df = spark.range(n).select(
        (F.col("id") % 2).alias("k"),
        F.when(F.col("id") % 10 != 0, F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("v"),
        F.lit(7).alias("same"),
    )
    found = grouped_medians(df, ["k"], ["v", "same"], [["k"], []], cut=1000)
    data = rows(df, "k", "v")
    assert bag(found, "level", "k", "v", "same", "rows") == sorted(
        [(0, k, median([v for g, v in data if g == k]), 7.0, n // 2) for k in (0, 1)]
        + [(1, None, median([v for _, v in data]), 7.0, n)],
        key=lambda r: [(v is not None, str(type(v)), v) for v in r],
    )
    # Nothing is exchanged by the measures themselves; what is counted per value is joined with its range first.
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in text
    assert not re.search(r"hashpartitioning\(k#\w+, v#", plan(found))
