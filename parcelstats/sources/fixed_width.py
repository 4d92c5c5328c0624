"""Fixed-width text extracts as DataFrames (OP-1, SRC-5..9, PIPE-1..4).

Each parser takes a DataFrame with one ``value`` column of raw lines, as
``spark.read.text`` gives it, and consists of projections: no exchange, no Python.
All fields are text; ``TYPES`` names the numeric ones for a typed table.

Nearly all lines are cut by bytes and trimmed of blanks, many times faster than by
character; see ``Encoding`` for the others.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstats.functions import strip_field, strip_space
from parcelstats.reference_data import TAX_CLASS_LABELS
from parcelstats.sources.csv import with_types
from parcelstats.sources.layouts import (
    ASSESSMENTS,
    DWELLINGS,
    OWNERS,
    SALES_FOOTER_TEXT,
    SALES_HEADER_PREFIX,
    SALES_STARTS,
    WINDOWS_1252_C1,
    fields,
    spans,
)

TYPES = {
    "assessments": {
        "tmk": "bigint",
        "parcel_year": "bigint",
        "assessed_land_value": "bigint",
        "land_exemption": "bigint",
        "assessed_building_value": "bigint",
        "building_exemption": "bigint",
    },
    "dwellings": {
        "tmk": "bigint",
        "parcel_year": "bigint",
        "bed_rooms": "bigint",
        "condo_type": "bigint",
        "year_built": "bigint",
        "effective_year_built": "bigint",
        "sf_of_living_area": "bigint",
        "building_value": "bigint",
    },
    "owners": {"tmk": "bigint", "mailing_zip1": "bigint"},
    "sales": {"parid": "bigint", "price": "bigint"},
}


def decode_windows_1252(value: Column) -> Column:
    """Text of windows-1252 bytes.

    The code page differs from ISO-8859-1 in one block only, so that no session
    setting is needed to decode it.
    """
    codes = "".join(map(chr, WINDOWS_1252_C1))
    return F.translate(_latin(value), codes, "".join(WINDOWS_1252_C1.values()))


def _latin(value: Column) -> Column:
    return F.decode(value.cast("binary"), "ISO-8859-1")


Step = Callable[[Column], Column]


@dataclass(frozen=True)
class Encoding:
    """How to read the bytes of a line.

    ``special`` tells the lines that must be cut by character and trimmed of every kind
    of white space. In all others a character is a byte and a blank the only white space.
    """

    special: Step
    text_of_line: Step
    text_of_bytes: Step


UTF_8 = Encoding(
    special=lambda line: line.rlike("[^ -~]"),
    text_of_line=lambda line: line,
    text_of_bytes=lambda field: field.cast("string"),
)
WINDOWS_1252 = Encoding(
    special=lambda line: _latin(line).rlike("[\\t-\\r\\x1c-\\x1f\\xa0]"),
    text_of_line=decode_windows_1252,
    text_of_bytes=decode_windows_1252,
)


def _prepared(
    lines: DataFrame, encoding: Encoding, strip: Callable[[Step], Step] = lambda trim: lambda line: line
) -> DataFrame:
    """(special, line): the decoded text of a special line, the raw one of any other."""
    raw = F.col("value")
    last = F.octet_length(raw) - 1
    without_return = F.substr(raw.cast("binary"), F.lit(1), last).cast("string")
    special = strip(strip_space)(encoding.text_of_line(raw))
    return (
        lines.select(F.when(raw.endswith("\r"), without_return).otherwise(raw).alias("value"))
        .select("value", encoding.special(raw).alias("special"))
        .select(
            "special",
            F.when(F.col("special"), special).otherwise(strip(F.trim)(raw)).alias("line"),
        )
    )


def _cut_lines(
    prepared: DataFrame,
    encoding: Encoding,
    names: Sequence[str],
    starts: Sequence[int],
    last_width: Step = lambda length: length,
    finish: Callable[[Step], Step] | None = None,
) -> DataFrame:
    """The stripped fields of each line, by characters or by bytes.

    The fields of a line are steps over one array: each step sees the value of the one
    before, where nested expressions would compute it anew for every mention, and the
    generated code stays small enough to be compiled. ``last_width`` gets the length of
    the line, ``finish`` the way to trim.
    """
    line, bytes_ = F.col("line"), F.col("bytes")

    def stripped(cut: Step, length: Column, trim: Step) -> Column:
        places = F.array(
            *[
                F.struct(
                    F.lit(start).alias("at"),
                    (F.lit(width) if width else last_width(length)).alias("width"),
                )
                for start, width in spans(starts)
            ]
        )
        found = F.transform(places, lambda p: strip_field(cut(p), trim))
        found = F.transform(found, lambda f: F.when(f == "", F.lit("0")).otherwise(f))
        return F.transform(found, finish(trim)) if finish else found

    by_character = stripped(
        lambda p: F.substr(line, p["at"], p["width"]), F.length(line), strip_space
    )
    by_byte = stripped(
        lambda p: encoding.text_of_bytes(F.substr(bytes_, p["at"], p["width"])),
        F.octet_length(line),
        F.trim,
    )
    return (
        prepared.withColumn("bytes", line.cast("binary"))
        .select(F.when(F.col("special"), by_character).otherwise(by_byte).alias("fields"))
        .select(*[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(names)])
    )


def parse_fixed_width(lines: DataFrame, layout: Sequence[tuple[str, int]]) -> DataFrame:
    """Cut each line into trimmed fields without leading zeros; empty fields are "0"."""
    names, starts = zip(*layout)
    return _cut_lines(_prepared(lines, UTF_8), UTF_8, names, starts)


def parse_assessments(lines: DataFrame) -> DataFrame:
    """8 fields; the tax class number becomes its label, an unknown one null."""
    parsed = parse_fixed_width(lines, fields(ASSESSMENTS))
    labels = F.array(*[F.lit(label) for label in TAX_CLASS_LABELS])
    number = F.col("tax_rate_class").try_cast("int")
    return parsed.withColumn("tax_rate_class", F.get(labels, number))


def count_unlabelled(assessments: DataFrame) -> DataFrame:
    """Parcels and those of them whose tax class number is unknown."""
    return assessments.agg(
        F.count("*").alias("parcels"),
        F.count_if(F.col("tax_rate_class").isNull()).alias("unknown_tax_class"),
    )


def parse_dwellings(lines: DataFrame) -> DataFrame:
    """45 fields."""
    return parse_fixed_width(lines, fields(DWELLINGS))


def parse_owners(lines: DataFrame) -> DataFrame:
    """11 fields in windows-1252; commas become bars."""
    names, starts = zip(*fields(OWNERS))
    barred = lines.select(F.replace(F.col("value"), F.lit(","), F.lit("|")).alias("value"))
    return _cut_lines(_prepared(barred, WINDOWS_1252), WINDOWS_1252, names, starts)


def sales_names(header: str) -> list[str]:
    """Field names in the header line of a sales file."""
    line = header.strip().lower()
    ends = [*SALES_STARTS[1:], len(line)]
    cuts = [line[start - 1 : end - 1] for start, end in zip(SALES_STARTS, ends)]
    names = [cut.strip().lstrip("0") or "0" for cut in cuts]
    return [name.removesuffix(",").strip().replace(",", "|") for name in names]


def parse_sales(lines: DataFrame, header: str) -> DataFrame:
    """15 fields in windows-1252, named by the header line.

    Blank lines, header lines and footers are dropped. Each field ends in a comma,
    which goes after the zeros have been stripped: a field of zeros is empty, unlike
    in the other files. The last field has lost its comma, the last character of the
    line, beforehand and is "0" if blank.
    """
    # One pattern, because the filter moves below the projection that decodes a line
    # and repeats it for every mention of the line.
    dropped = [re.escape(SALES_HEADER_PREFIX), ".*" + re.escape(SALES_FOOTER_TEXT)]
    dropped.append(re.escape(header.strip()) + "$")
    data = "(?s)^" + "".join(f"(?!{pattern})" for pattern in dropped) + "."
    prepared = _prepared(lines, WINDOWS_1252, strip=lambda trim: trim)
    return _cut_lines(
        prepared.filter(F.col("line").rlike(data)),
        WINDOWS_1252,
        sales_names(header),
        SALES_STARTS,
        last_width=lambda length: F.greatest(length - SALES_STARTS[-1], F.lit(0)),
        finish=_without_comma,
    )


def _without_comma(strip: Step) -> Step:
    def finish(field: Column) -> Column:
        shorter = F.substr(field, F.lit(1), F.length(field) - 1)
        cut = F.when(field.endswith(","), shorter).otherwise(field)
        return F.replace(strip(cut), F.lit(","), F.lit("|"))

    return finish


def read_lines(spark: SparkSession, path: str, line_feed_only: bool = False) -> DataFrame:
    """Raw lines. Files in a legacy code page end lines with a line feed only."""
    reader = spark.read.option("lineSep", "\n") if line_feed_only else spark.read
    return reader.text(path)


def header_line(lines: DataFrame) -> str:
    """The header of a sales file: found in all its parts, in one pass.

    The header is repeated between the data, so any of its copies will do; copies that
    differ are an error. A file whose header does not begin as usual has it in its first
    line that is not blank.
    """
    text = strip_space(decode_windows_1252(F.col("value")))
    filled = lines.select(text.alias("value")).filter(F.col("value") != "")
    copies = filled.filter(F.col("value").startswith(SALES_HEADER_PREFIX))
    first, last = copies.agg(F.min("value"), F.max("value")).first()
    if first is None:
        found = filled.head(1)
        if not found:
            raise ValueError("sales file without a header line")
        return found[0]["value"]
    if first != last:
        raise ValueError(f"sales files with different headers: {first!r}, {last!r}")
    return first


def read_assessments(spark: SparkSession, path: str) -> DataFrame:
    return with_types(parse_assessments(read_lines(spark, path)), TYPES["assessments"])


def read_dwellings(spark: SparkSession, path: str) -> DataFrame:
    return with_types(parse_dwellings(read_lines(spark, path)), TYPES["dwellings"])


def read_owners(spark: SparkSession, path: str) -> DataFrame:
    lines = read_lines(spark, path, line_feed_only=True)
    return with_types(parse_owners(lines), TYPES["owners"])


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """The header is read once, as the schema of the file; the data is not collected."""
    lines = read_lines(spark, path, line_feed_only=True)
    return with_types(parse_sales(lines, header_line(lines)), TYPES["sales"])
