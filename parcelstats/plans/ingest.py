"""Raw fixed-width extracts to typed Parquet tables (PIPE-1..4, SNK-2)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from parcelstats.sources.csv import infer_types, with_types, write_parquet
from parcelstats.sources.fixed_width import (
    header_line,
    parse_assessments,
    parse_dwellings,
    parse_owners,
    parse_sales,
    read_lines,
)

def parsed(spark: SparkSession, kind: str, raw_path: str) -> DataFrame:
    """All fields of one raw extract as text."""
    if kind == "assessments":
        return parse_assessments(read_lines(spark, raw_path))
    if kind == "dwellings":
        return parse_dwellings(read_lines(spark, raw_path))
    lines = read_lines(spark, raw_path, line_feed_only=True)
    if kind == "owners":
        return parse_owners(lines)
    if kind == "sales":
        return parse_sales(lines, header_line(lines))
    raise ValueError(f"unknown extract: {kind}")


def ingest(
    spark: SparkSession,
    kind: str,
    raw_path: str,
    table_path: str,
    types: Mapping[str, str] | None = None,
) -> None:
    """Parse one raw extract and write it as Parquet, split by split, without an exchange.

    Without ``types`` a first pass over all rows finds the type that the values of each
    column have; texts stay as they are, and an empty text is null in other columns.
    """
    fields = parsed(spark, kind, raw_path)
    write_parquet(with_types(fields, infer_types(fields) if types is None else types), table_path)
