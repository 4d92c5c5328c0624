"""Runs the registered queries on Spark and DuckDB and compares the rows.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame


def duckdb_on(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
            return ""
        if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
            return str(bool(value))
        if isinstance(value, (int, float)) or hasattr(value, "dtype"):
            return repr(float(value))
        return str(value)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(cell, row)) for row in frame.itertuples(index=False, name=None))


def differences(actual: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = pd.DataFrame(result.fetchall(), columns=names, dtype=object)
    rows = [tuple(row) for row in actual.collect()]
    found = pd.DataFrame(rows, columns=actual.columns, dtype=object)
    if sorted(found.columns) != sorted(expected.columns):
        return [f"columns {sorted(found.columns)} != {sorted(expected.columns)}"]
    left, right = canonical(found), canonical(expected)
    if left == right:
        return []
    only_left, only_right = sorted(set(left) - set(right)), sorted(set(right) - set(left))
    return [
        f"{len(left)} rows, expected {len(right)}; columns {sorted(found.columns)}",
        f"only spark ({len(only_left)}): {only_left[:4]}",
        f"only sql   ({len(only_right)}): {only_right[:4]}",
    ]


def main(arguments: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from parcelstats.session import local_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(queries())
    spark, connection, sql = local_session(), duckdb_on(folder), oracle_sql()
    failures = 0
    for name in wanted:
        start = time.time()
        try:
            found = differences(queries()[name](spark, folder), connection, sql[name])
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failures += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.2f}s", flush=True)
        for line in found:
            print("     ", line)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
