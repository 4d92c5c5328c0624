"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstats.llm.tables import settle


def _starred(links: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them.

    With ``larger_only`` every neighbour above the node moves ("large star"); otherwise
    the node and its smaller neighbours do ("small star"). The smallest neighbour comes
    from an aggregate with partial sums, so a node with a third of all links stays cheap.
    """
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if larger_only:
        around = down.union(links.select(F.least("a", "b"), F.greatest("a", "b")))
        lowest = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = around.filter("v > u").join(lowest, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = (
            down.join(lowest, "u")
            .select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("u", "m"))
        )
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every node that has a link: (node, component).

    Alternates large and small stars until the links no longer change, which takes a
    number of rounds that grows with the logarithm of the longest chain. Each round is a
    few joins on the node and is written to the shared folder. Null ends and loops count
    as no link; repeated links count once.
    """
    now = settle(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    )
    mark = None
    while True:
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.bit_xor(F.xxhash64("a", "b"))
        ).first()
        if seen == mark or seen[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select("b", "b").distinct()
            )
        mark = seen
        now = settle(_starred(_starred(now, larger_only=True), larger_only=False))
