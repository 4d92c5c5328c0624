"""OP-16, OP-17, OP-19..22, OP-27 and OP-26."""

import random

from pyspark.sql import functions as F

from parcelstats.operators.geo import (
    add_complex_code,
    add_tract_region,
    add_zone_region,
    mark_special_complexes,
    special_complex_split,
)
from parcelstats.operators.property import (
    add_price_per_sqft,
    add_resident_type,
    dwelling_attributes,
    owner_rollup,
    parcel_dwelling_base,
    parcel_enriched,
    sale_normalise,
)
from parcelstats.operators.skew import hot_keys
from tests.helpers import bag, plan, rows

DWELLINGS = "tmk long, sf_of_living_area long, year_built long, bed_rooms long, condo_type long"
ASSESSMENTS = (
    "tmk long, tax_rate_class string, assessed_building_value long, assessed_land_value long,"
    " building_exemption long"
)
SALES = (
    "parid string, saledate string, recorddate string, price long, instruno string,"
    " landcourt_no string, cert_no string"
)
A, B, C = 2450010010001, 2380010010001, 2600010010001


def test_dwelling_attributes_null_rules(spark):
    df = spark.createDataFrame(
        [(1, 199, 1, 1, 0), (2, 200, 1, 1, 2), (3, None, 1, 1, None)], DWELLINGS
    )
    assert bag(dwelling_attributes(df), "tmk", "sf_of_living_area", "is_condo", "home_type") == [
        (1, None, False, "Single Family Home"),
        (2, 200, True, "Condo"),
        (3, None, None, "Single Family Home"),
    ]


def test_base_takes_one_class_and_the_dwelling_without_area(spark):
    assessments = spark.createDataFrame(
        [
            (A, "tvr-strh", 1, 1, 1),
            (A, "owner-occupied", 2, 2, 2),
            (B, "commercial", 3, 3, 3),
            (C, "long-term-rental", 4, 4, 4),
            (123, "owner-occupied", 5, 5, 5),
        ],
        ASSESSMENTS,
    )
    dwellings = spark.createDataFrame(
        [(A, 900, 1990, 3, 0), (A, 100, 2001, 1, 1), (B, 500, 1, 1, 1), (C, 700, 1980, 2, None)], DWELLINGS
    )
    found = parcel_dwelling_base(assessments, dwellings)
    assert bag(found, "tmk", "tax_rate_class", "sf_of_living_area", "is_condo", "region") == [
        (A, "owner-occupied", None, True, "West Maui"),
        (C, "long-term-rental", 700, None, None),
    ]


def test_base_needs_one_exchange_per_side(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = parcel_dwelling_base(
            spark.createDataFrame([], ASSESSMENTS).repartition(3, "assessed_land_value"),
            spark.createDataFrame([], DWELLINGS).repartition(3, "year_built"),
        )
        text = plan(base)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("ENSURE_REQUIREMENTS") == 2


def test_sales_fall_back_to_the_record_year(spark):
    rest = ("i", "l", "c")
    df = spark.createDataFrame(
        [
            ("450010010001", "1999-05-01", "2000-01-01", 20001, *rest),
            ("1", "1900-01-01", "2000-01-01", 30000, *rest),
            ("2", None, "2001-01-01", 30000, *rest),
            ("3", "xx", "2002-01-01", 30000, *rest),
            ("4", "1999-05-01", "2000-01-01", 20000, *rest),
            ("5", "1983-12-31", "1990-01-01", 30000, *rest),
            ("6", "2024-12-31", None, 30000, *rest),
            ("7", "2025-01-01", "2024-01-01", 30000, *rest),
            ("8", "1900-01-01", None, 30000, *rest),
            ("9", "1999-05-01", "2000-01-01", None, *rest),
        ],
        SALES,
    )
    assert bag(sale_normalise(df), "tmk", "sale_year") == [
        (21, 2000), (22, 2001), (23, 2002), (26, 2024), (2450010010001, 1999),
    ]


def test_owner_rollup_ignores_nulls(spark):
    df = spark.createDataFrame(
        [(1, 96753), (1, 99999), (2, None), (3, 90210), (3, None)], "tmk long, mailing_zip1 long"
    )
    assert bag(owner_rollup(df)) == [(1, 99999, True), (2, None, False), (3, 90210, False)]


def test_price_per_area_and_resident_type(spark):
    df = spark.createDataFrame(
        [("owner-occupied", 1000, 400), ("tvr-strh", 1000, 0), (None, None, 400)],
        "tax_rate_class string, assessed_building_value long, sf_of_living_area long",
    )
    found = add_resident_type(add_price_per_sqft(df))
    assert rows(found, "ppsf", "resident_type") == [
        (3.0, "Resident"), (None, "Non-Resident"), (None, "Non-Resident"),
    ]


def test_enriched_equals_pairing_all_rows_of_a_parcel(spark):
    rng = random.Random(5)
    keys = [A + i for i in range(12)]
    classes = ["owner-occupied", "tvr-strh", "commercial", "long-term-rental"]
    values = [None, -700, -3, 0, 400, 90_000, 90_001]
    current = [(rng.choice(keys), rng.choice(classes)) for _ in range(25)]
    prior = [(rng.choice(keys), rng.choice(values), rng.choice([1, 2]), 7) for _ in range(20)]
    cards = [
        (rng.choice(keys), rng.choice([None, 100, 250, 300, 1000]), rng.choice([1990, 2000, None]), 2, rng.choice([None, 0, 1]))
        for _ in range(30)
    ]
    owners = [(rng.choice(keys), rng.choice([None, 96753, 90210])) for _ in range(15)]
    found = parcel_enriched(
        spark.createDataFrame(current, "tmk long, tax_rate_class string"),
        spark.createDataFrame(
            prior, "tmk long, assessed_building_value long, assessed_land_value long, building_exemption long"
        ),
        spark.createDataFrame(cards, DWELLINGS),
        spark.createDataFrame(owners, "tmk long, mailing_zip1 long"),
    )

    def nulls_first(*row):
        return tuple((v is not None, v if v is not None else 0) for v in row)

    expected = []
    for key in keys:
        pairs = []
        for _, label in [r for r in current if r[0] == key and r[1] != "commercial"]:
            for _, value, land, exempt in [r for r in prior if r[0] == key] or [(key, None, None, None)]:
                for _, area, built, beds, kind in [r for r in cards if r[0] == key]:
                    area = area if area is not None and area >= 200 else None
                    condo = None if kind is None else kind > 0
                    order = nulls_first(label, value, land, exempt, None if area is None else -area, built, beds, condo)
                    ratio = value / area if area and value is not None else None
                    pairs.append((order, label, value, area, built, condo, ratio))
        if pairs:
            first = min(pairs, key=lambda p: p[0])
            areas = [p[3] for p in pairs if p[3] is not None]
            ratios = [int(p[6] + (0.5 if p[6] >= 0 else -0.5)) for p in pairs if p[6] is not None]
            zips = [z for k, z in owners if k == key and z is not None]
            known = any(k == key for k, _ in owners)
            expected.append(
                (key, first[1], first[2], max(areas, default=None), first[4], first[5],
                 float(max(ratios)) if ratios else None, max(zips, default=None),
                 96753 in zips if known else None)
            )
    assert bag(
        found, "tmk", "tax_rate_class", "assessed_building_value", "sf_of_living_area", "year_built",
        "is_condo", "ppsf", "mailing_zip", "is_maui_owner",
    ) == expected


def test_zone_regions(spark):
    zones = {11: "East Maui", 19: "East Maui", 20: None, 21: "South Maui", 22: "Upcountry", 29: "Upcountry",
             30: None, 31: "Central Maui", 38: "Central Maui", 39: "South Maui", 40: None, 41: "West Maui",
             45: "West Maui", 46: "West Maui", 48: "West Maui", 49: "Lanai", 50: "Molokai", 59: "Molokai",
             60: None, 10: None}
    df = spark.createDataFrame([(int(f"2{z}0010010001"),) for z in zones], "tmk long")
    found = add_zone_region(df)
    assert dict(rows(found, "zone_section", "region")) == zones
    assert bag(found.filter("is_lahaina"), "zone_section") == [(45,), (46,)]
    assert found.filter("is_lahaina and is_west_maui").count() == 2


def test_tract_regions_fall_back_to_hundreds(spark):
    df = spark.createDataFrame([(30302,), (30399,), (31805,), (39900,), (None,)], "tracta long")
    assert bag(add_tract_region(df)) == [(30302, "South Maui"), (30399, "Upcountry"), (31805, "Molokai")]


def test_complex_codes_and_names(spark):
    df = spark.createDataFrame([(2390010020001,), (2450010010001,)], "tmk long")
    found = mark_special_complexes(add_complex_code(df))
    assert bag(found, "tmk_sub", "complex_name", "is_special") == [
        (39001002, "MAUI SUNSET", True), (45001001, None, False),
    ]


def test_complexes_of_the_caller_are_not_broadcast_blindly(spark):
    df = add_complex_code(spark.createDataFrame([(2390010020001,), (2450010010001,)], "tmk long"))
    own = spark.createDataFrame([(45001001,), (45001001,)], "tmk_sub long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = mark_special_complexes(df, own, hot_keys(df, "tmk_sub", 0))
        assert bag(found, "tmk_sub", "is_special") == [(39001002, False), (45001001, True)]
        assert "SortMergeJoin" in plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_subsets_of_condominiums(spark):
    west, south, central, east = 2450010010001, 2390010010001, 2380010010001, 2110010010001
    data = [
        (west, True, "tvr-strh", True),
        (south, False, "owner-occupied", True),
        (south, False, "tvr-strh", True),
        (central, True, "long-term-rental", True),
        (central, False, None, True),
        (east, True, "owner-occupied", True),
        (west, True, "tvr-strh", False),
        (west, True, "tvr-strh", None),
    ]
    df = spark.createDataFrame(data, "tmk long, is_special boolean, tax_rate_class string, is_condo boolean")
    counts = special_complex_split(add_zone_region(df)).groupBy("desc").agg(F.count("*"))
    assert bag(counts) == [
        ("central-maui-condos", 1),
        ("west-south-maui-minatoya-condos", 1),
        ("west-south-maui-non-minatoya-condos", 1),
    ]
