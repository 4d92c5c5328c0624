"""Session for tests and the bench. On a cluster the session comes from outside."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parcelstats")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Small files are split as well, so that all cores take part.
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
