"""Equi-join of a skewed side with a side that is unique on the key (JOIN-1, JOIN-3).

Adaptive skew handling only splits joins that read two bare shuffles. The joins
here read window and aggregate output, so the hot keys are split explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
SLICES = 64
#: Most hot keys, and keys that a sketch follows to find them.
MOST_HOT = 1000
TRACKED = 20_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than about ``hot_rows`` rows, at most ``MOST_HOT`` of them.

    The most frequent keys come from a sketch of fixed size that every task keeps of its own
    rows, so that no row is exchanged to find them. A key that the sketch can miss has less
    than about one row in ``TRACKED / 4``.
    """
    top = F.expr(f"approx_top_k(`{key}`, {MOST_HOT}, {TRACKED})")
    found = df.filter(F.col(key).isNotNull()).agg(top.alias("_top")).select(F.explode("_top").alias("_key"))
    return found.filter(F.col("_key.count") > hot_rows).select(F.col("_key.item").alias(key))


def join_spread(
    facts: DataFrame,
    unique: DataFrame,
    key: str,
    hot: DataFrame,
    how: str = "inner",
    slices: int = SLICES,
) -> DataFrame:
    """Join ``facts`` to ``unique`` (one row per key) with the rows of hot keys spread.

    Rows of a hot key go to ``slices`` slices and its single partner row is
    repeated once per slice; other keys keep one slice. The slice depends on the
    row and on its input partition, so that copies of one row spread as well, and
    a task that is run again assigns the same slices.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    # MOST_HOT rows at most.
    marked = F.broadcast(hot.select(key, F.lit(True).alias("_hot")))
    spread = F.xxhash64(*facts.columns) + F.spark_partition_id()
    left = facts.join(marked, key, "left").withColumn(
        "_slice", F.when(F.col("_hot"), F.pmod(spread, F.lit(slices))).otherwise(0).cast("long")
    )
    last = F.when(F.col("_hot"), F.lit(slices - 1)).otherwise(0).cast("long")
    right = unique.join(marked, key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("long"), last))
    )
    return left.drop("_hot").join(right.drop("_hot"), [key, "_slice"], how).drop("_slice")
