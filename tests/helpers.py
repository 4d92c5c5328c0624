"""Small helpers of the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows in their order."""
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def bag(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows in any order, nulls first."""
    return sorted(rows(df, *columns), key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
