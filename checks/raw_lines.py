"""Raw extract lines written from driver rows, the inverse of the fixed-width parsers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.fixtures import Inputs, _tmk
from parcelstats.functions import outside_whole_stage
from parcelstats.sources.layouts import WINDOWS_1252_C1

# Fields of the dwellings and of the sales with their widths, stated here once
# more so that the layouts of the library are checked too.
DWELLING_WIDTHS = {
    "tmk": 13, "parcel_year": 5, "card_number": 5, "story_height": 7, "exterior_wall": 3,
    "framing": 3, "style_occupancy": 2, "roof_design": 3, "full_baths": 7, "half_baths": 7,
    "additional_fixtures": 7, "total_fixtures": 6, "air_conditioning": 1, "attic": 1,
    "total_rooms": 5, "bed_rooms": 5, "family_rooms": 5, "foundation": 3, "basement": 1,
    "construction": 2, "flooring": 3, "interior_wall_structure": 3, "roof_material": 3,
    "interior_wall_material": 3, "condo_floor_level": 8, "condo_type": 3, "condo_view": 3,
    "condo_parking_spaces": 3, "condo_style": 3, "duplex": 3, "year_built": 5,
    "effective_year_built": 5, "physical_condition": 1, "building_grade": 3,
    "building_shape_factor": 3, "percent_complete": 11, "ceiling_material": 3,
    "sf_of_living_area": 7, "sf_of_bldg_foot_print": 8, "addition_living_area_in_sf": 8,
    "building_value": 11, "built_in_fire_place_linear_feet": 6, "no_prefab_fire_places": 2,
    "no_wood_burning_fire_places": 2, "cost_and_design_adjustment": None,
}
SALES_WIDTHS = [18, 11, 11, 11, 21, 41, 41, 41, 9, 9, 41, 41, 41, 3, None]
SALES_NAMES = [
    "parid", "saledate", "recorddate", "price", "instruno", "landcourt_no", "cert_no", "seller",
    "book", "page", "buyer", "note", "source", "cd", "remark",
]


def zeros(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def left(value: Column, width: int) -> Column:
    return F.rpad(value.cast("string"), width, " ")


def right(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, " ")


def encode_windows_1252(text: Column) -> Column:
    """Text whose bytes are those of the legacy code page, as a raw file would hold them."""
    codes = "".join(map(chr, WINDOWS_1252_C1))
    latin = F.translate(text, "".join(WINDOWS_1252_C1.values()), codes)
    return F.encode(latin, "ISO-8859-1").cast("string")


def assessment_lines(inputs: Inputs) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    building = F.when(F.col("p_partkey") % 10 == 0, 0).otherwise(F.floor(price * 1000))
    line = F.concat(
        zeros(_tmk().cast("bigint"), 13),
        zeros(2000 + size % 25, 5),
        left(size % 7, 4),
        zeros(size % 15, 4),
        zeros(F.floor(price * 500), 13),
        F.when(size % 3 == 0, F.lit(" " * 13)).otherwise(right(size * 10, 13)),
        zeros(building, 13),
        (size * 1000).cast("string"),
    )
    return inputs.parcel_key().select(line.alias("value"))


def dwelling_modulus(width: int | None) -> int:
    return 10 ** min(width or 6, 9)


def dwelling_lines(inputs: Inputs) -> DataFrame:
    """45 fields: the key, then numbers padded in three ways.

    Grades are letters here and there, percentages have a fraction.
    """
    parts = [zeros(2000000000000 + F.col("l_partkey"), 13)]
    order = F.col("l_orderkey")
    for i, (name, width) in list(enumerate(DWELLING_WIDTHS.items()))[1:]:
        number = (order * (i + 3) + F.col("l_linenumber") * 7 + i) % dwelling_modulus(width)
        value = number.cast("string")
        if name == "building_grade":
            value = F.when(order % 97 == 0, "B+").otherwise(value)
        if name == "percent_complete":
            value = F.concat((number + 1).cast("string"), F.lit(".5"))
        parts.append([zeros, left, right][i % 3](value, width or 8))
    parts[-1] = outside_whole_stage(parts[-1])
    return inputs.table("lineitem").select(F.concat(*parts).alias("value"))


def owner_lines(inputs: Inputs) -> DataFrame:
    nation, customer = F.col("c_nationkey"), F.col("c_custkey")
    line = F.concat(
        zeros(2000000000000 + customer, 13),
        left(F.concat("c_name", F.lit(", é “"), "c_mktsegment", F.lit("”")), 40),
        left(F.col("c_mktsegment"), 40),
        F.lit(" " * 121),
        left(F.concat(customer.cast("string"), F.lit(" Main St, Apt €"), nation.cast("string")), 80),
        left(F.concat(F.lit("Kihei, HI "), 90000 + nation), 92),
        left(F.lit("Kihei"), 40),
        F.lit("HI"),
        zeros(90000 + nation, 5),
        zeros(customer % 10000, 4),
        F.when(nation == 7, "\r").otherwise("USA\r"),
    )
    return inputs.table("customer").select(encode_windows_1252(line).alias("value"))


def sales_header() -> str:
    """The header line; every field but the last is padded to its width."""
    padded = [
        (name.upper().ljust(width - 1) if width else name.upper()) + ","
        for name, width in zip(SALES_NAMES, SALES_WIDTHS)
    ]
    return "".join(padded)


def sales_lines(inputs: Inputs) -> DataFrame:
    """Sales with repeated headers, footers and blank lines between them."""
    order = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "dd-MMM-yy")
    values = [
        zeros(order, 12),
        day,
        F.when(order % 4 == 0, F.lit("")).otherwise(day),
        F.floor("o_totalprice"),
        F.col("o_orderpriority"),
        F.when(order % 3 == 0, F.lit("0")).otherwise(order),
        zeros(order % 7, 6),
        F.concat(F.lit("Peña, “"), "o_orderstatus", F.lit("”, Trust")),
        order % 1000,
        zeros(order % 100, 5),
        F.concat(F.lit("00Buyer "), F.col("o_custkey").cast("string")),
        F.lit(""),
        F.lit("A,B"),
        order % 10,
        F.when(order % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("r"), order.cast("string"))),
    ]
    parts = [
        F.concat(left(value, width - 1) if width else value.cast("string"), F.lit(","))
        for value, width in zip(values, SALES_WIDTHS)
    ]
    data = encode_windows_1252(F.concat(*parts))
    noise = F.array(
        F.lit(sales_header()), F.lit("   "), F.concat(order.cast("string"), F.lit(" rows selected."))
    )
    lines = F.when(order % 50 == 0, F.concat(F.array(data), noise)).otherwise(F.array(data))
    return inputs.table("orders").select(F.explode(lines).alias("value"))


def csv_lines(inputs: Inputs, columns: list[str]) -> DataFrame:
    """Orders as CSV lines behind a header, some too short, some too long, some with bad values.

    One partition, because the header must stay in front.
    """
    order = F.col("o_orderkey")
    values = {
        "Order Key": order.cast("string"),
        "Total / Price": F.when(order % 17 == 0, "n/a").otherwise(F.floor("o_totalprice").cast("string")),
        "Order Date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "Priority": F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""x"""')),
        "Extra": F.lit("-"),
    }
    whole = F.concat_ws(",", *[values[c] for c in columns])
    short = F.concat_ws(",", *[values[c] for c in columns[:2]])
    line = F.when(order % 13 == 0, short).when(order % 11 == 0, F.concat(whole, F.lit(",more,more"))).otherwise(whole)
    header = inputs.spark.range(1).select(F.lit(",".join(columns)).alias("value"))
    return header.union(inputs.table("orders").select(line.alias("value"))).coalesce(1)
