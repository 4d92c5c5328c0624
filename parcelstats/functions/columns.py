"""Column expressions. All but ``outside_whole_stage`` stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white-space characters (control separators included).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(value: Column) -> Column:
    """Trim white space of every kind. Blanks go first, which is much cheaper."""
    return F.btrim(F.trim(value), F.lit(WHITESPACE))


def strip_field(value: Column, strip: Callable[[Column], Column] = strip_space) -> Column:
    """Trim and drop leading zeros; a field without content becomes empty."""
    return F.ltrim(strip(value), F.lit("0"))


def outside_whole_stage(value: Column) -> Column:
    """The same value, by a function that keeps its projection out of whole-stage code.

    Whole-stage code computes all columns of a projection in one method, and from 8,000 bytes
    on the JVM interprets a method instead of compiling it, which takes many times longer.
    A projection by itself is generated as many short methods.
    """
    return F.get(F.transform(F.array(value), lambda same: same), F.lit(0))


def lenient_long(column: str) -> Column:
    """Whole number, or null where the text is not one."""
    return F.col(column).try_cast("bigint")


def year_prefix(column: str) -> Column:
    """Year from the first four characters of a date string, null if malformed."""
    return F.substring(F.col(column), 1, 4).try_cast("bigint")


def rounded_long(value: Column) -> Column:
    return F.round(value, 0).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, to one digit; null for an empty whole."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 1)
