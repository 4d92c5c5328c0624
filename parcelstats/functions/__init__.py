"""Column expressions shared by the operators."""

from parcelstats.functions.columns import (
    lenient_long,
    outside_whole_stage,
    percent,
    rounded_long,
    strip_field,
    strip_space,
    year_prefix,
)

__all__ = [
    "lenient_long",
    "outside_whole_stage",
    "percent",
    "rounded_long",
    "strip_field",
    "strip_space",
    "year_prefix",
]
