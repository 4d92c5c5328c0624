"""OP-12, OP-13, OP-23, OP-25."""

from random import Random

import pytest
from pyspark.sql import functions as F

from parcelstats.operators.series import (
    annual_reference_income,
    interpolate_by_reference,
    normalise_year_ranges,
    splice_series,
)
from tests.helpers import bag, plan, rows


def test_splice_switches_at_the_year(spark):
    a = spark.createDataFrame([(1999, 1), (2000, 2)], "year long, v long")
    b = spark.createDataFrame([(1999, 10), (2000, 20)], "year long, v long")
    assert bag(splice_series(a, b)) == [(1999, 1), (2000, 20)]


def test_year_ranges(spark):
    df = spark.createDataFrame([("1990",), ("2011-2015",), ("2011-",), (None,)], "year string")
    assert rows(normalise_year_ranges(df)) == [("1990",), ("2015",), (None,), (None,)]


def test_reference_income_is_lenient(spark):
    df = spark.createDataFrame(
        [("1993-01-01", "100"), ("1994-01-01", ".")], "observation_date string, median_household_income string"
    )
    assert rows(annual_reference_income(df)) == [(1993, 100), (1994, None)]


def test_interpolation_inside_and_constant_extension_outside(spark):
    known = spark.createDataFrame([("A", 2001, 200), ("A", 2003, 400), ("B", 2050, 1)], "region string, year long, v long")
    reference = spark.createDataFrame(
        [(2000, 100), (2001, 100), (2002, 100), (2003, 100), (2005, 50), (2006, None)], "year long, v long"
    )
    found = interpolate_by_reference(known, reference, "v")
    assert bag(found.filter("region = 'A'"), "year", "v") == [
        (2000, 200), (2001, 200), (2002, 300), (2003, 400), (2005, 200), (2006, None),
    ]
    # No known ratio at all: rows without a value. 2004 has no reference and drops out.
    assert bag(found.filter("region = 'B'"), "v") == [(None,)] * 6


def test_known_points_are_reproduced_and_no_cross_join_is_used(spark):
    known = spark.createDataFrame([("A", y, 1000 + 37 * y % 91) for y in range(0, 40, 3)], "region string, year long, v long")
    reference = spark.createDataFrame([(y, 500 + y) for y in range(40)], "year long, v long")
    found = interpolate_by_reference(known, reference, "v")
    assert set(bag(known, "year", "v")) <= set(bag(found, "year", "v"))
    text = plan(found)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_one_reference_position_does_not_divide_by_zero(spark):
    known = spark.createDataFrame([("A", 1, 10)], "region string, year long, v long")
    reference = spark.createDataFrame([(1, 20), (2, 0)], "year long, v long")
    assert bag(interpolate_by_reference(known, reference, "v"), "year", "v") == [(1, 10), (2, 0)]


def test_reference_positions_may_lie_far_apart(spark):
    known = spark.createDataFrame([("A", 0, 10)], "region string, year long, v long")
    reference = spark.createDataFrame([(0, 20), (3_000_000_000, 40)], "year long, v long")
    assert bag(interpolate_by_reference(known, reference, "v"), "year", "v") == [(0, 10), (3_000_000_000, 20)]


def test_a_repeated_reference_position_fails(spark):
    known = spark.createDataFrame([("A", 0, 10)], "region string, year long, v long")
    reference = spark.createDataFrame([(0, 20), (0, 40)], "year long, v long")
    with pytest.raises(Exception, match="more than one reference for 0"):
        interpolate_by_reference(known, reference, "v").collect()


def filled_by_hand(known, reference, groups):
    """(group, position, value) as the rule is stated, one position at a time."""
    out = []
    for g in groups:
        ratios = sorted((p, v / reference[p]) for h, p, v in known if h == g and v is not None and reference.get(p))
        for p, r in reference.items():
            before = [x for x in ratios if x[0] <= p]
            after = [x for x in ratios if x[0] >= p]
            if r is None or not ratios:
                out.append((g, p, None))
                continue
            (a, x), (b, y) = (before or after)[-1 if before else 0], (after or before)[0 if after else -1]
            ratio = x if a == b else x + (y - x) * ((p - a) / (b - a))
            out.append((g, p, ratio * r))
    return out


@pytest.mark.parametrize("segment", [1, 7, 10_000])
def test_segments_do_not_change_the_values(spark, segment):
    random = Random(segment)
    reference = {p: random.choice([None, 0, 100, 150, 400]) for p in random.sample(range(-500, 500), 200)}
    known = [
        (g, p, random.randint(1, 900))
        for g, share in (("dense", 0.9), ("thin", 0.02), ("one", 0.0))
        for p in reference
        if random.random() < share
    ]
    known += [("one", next(p for p, r in reference.items() if r), 77), ("outside", 9999, 5)]
    found = interpolate_by_reference(
        spark.createDataFrame(known, "region string, year long, v long"),
        spark.createDataFrame(list(reference.items()), "year long, v long"),
        "v",
        segment=segment,
    )
    expected = {(g, p): v for g, p, v in filled_by_hand(known, reference, ["dense", "thin", "one", "outside"])}
    got = {(r.region, r.year): r.v for r in found.collect()}
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert (got[key] is None) == (value is None)
        assert value is None or abs(got[key] - value) <= 0.5 + 1e-6 * abs(value), key


def test_a_long_group_is_filled_by_many_tasks(spark):
    n = 200_000
    reference = spark.range(n).select(F.col("id").alias("year"), F.lit(100).cast("long").alias("v"))
    known = spark.createDataFrame([("A", 0, 100), ("A", n - 1, 300)], "region string, year long, v long")
    found = interpolate_by_reference(known, reference, "v", segment=1000)
    assert "hashpartitioning(region" in plan(found) and "_segment" in plan(found)
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == n
    assert found.filter("year = 100000").first()["v"] == 200
    # 1024 segments fall on all partitions alike.
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    assert max(r["count"] for r in sizes) < 2 * n / min(int(parts), len(sizes))
