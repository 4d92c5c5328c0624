"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one that ``spark.checkpoint.dir`` names.

    Only a session on one machine (``local[...]``) may go without that setting; elsewhere
    a missing setting is an error, since executors would not see a folder of the driver.
    """
    context = spark.sparkContext
    shared = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="parcelstats-")
        context.setCheckpointDir(shared)
    return f"{shared}/llm-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    The table survives lost executors and cuts the lineage; plans behind it are not
    repeated by later steps.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused_names(columns: list[str], n: int, prefix: str) -> list[str]:
    """``n`` column names of helpers that no column of a caller has."""
    free = (f"{prefix}_{k}" for k in range(len(columns) + n))
    return [name for name in free if name not in columns][:n]
