"""Times the headline queries and prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Every query
runs once to warm up and is then timed from building the DataFrame to the last row;
the rows go to a sink that discards them. The raw lines of the fixed-width parsers are
written as text files before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import raw_lines  # noqa: E402
from checks.fixtures import Inputs  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from parcelstats.session import local_session  # noqa: E402
from parcelstats.sources.fixed_width import parse_dwellings, parse_sales, read_lines  # noqa: E402

HEADLINE = [
    "median_sales_sfh",
    "median_sales_condo",
    "affordable_sales",
    "construction_by_decade",
    "condo_profile",
    "household_income",
    "household_income_interpolated",
    "price_to_income",
    "parcel_enriched",
    "largest_per_key",
    "bundle_dedupe",
    "median_generic",
    "weighted_median_generic",
    "interpolate_generic",
    "dense_grid_generic",
    "fixed_width_dwellings",
    "fixed_width_sales",
]


def raw_files(spark, folder: str, scratch: str) -> dict[str, Callable[[], DataFrame]]:
    """The raw lines as files, and how to parse them."""
    inputs = Inputs(spark, folder)
    raw_lines.dwelling_lines(inputs).write.text(f"{scratch}/dwellings")
    raw_lines.sales_lines(inputs).write.text(f"{scratch}/sales")
    sales = read_lines(spark, f"{scratch}/sales", line_feed_only=True)
    return {
        "fixed_width_dwellings": lambda: parse_dwellings(read_lines(spark, f"{scratch}/dwellings")),
        "fixed_width_sales": lambda: parse_sales(sales, raw_lines.sales_header()),
    }


def run(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    with tempfile.TemporaryDirectory(prefix="parcelstats-bench-") as scratch:
        queries = {name: partial(QUERIES[name], spark, folder) for name in HEADLINE}
        queries |= raw_files(spark, folder, scratch)
        for build in queries.values():
            run(build)
        seconds = {name: round(run(build), 3) for name, build in queries.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": spark.sparkContext.defaultParallelism,
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
