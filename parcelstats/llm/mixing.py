"""Mixing sources to target weights by systematic sampling.

Each source gets a target in words. Its documents stand in a fixed order, their expected
copies are summed up along it from one random offset, and a document is taken once for every
whole number that the sum passes on it. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstats.llm.tables import unused_names

#: A source is never taken more often than this.
MOST_COPIES = 3
#: Weights of the sources in the order of their names, repeated as needed.
WEIGHTS = (1, 2, 3)
SEED = "mix"
#: Names of helper columns.
HELPERS = ("_place", "_order", "_part", "_source", "_tie", "_s", "_p", "_q", "_before")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than 0x20 and 0x09-0x0D; 0 for null."""
    inner = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(inner, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, n, source_size, target) for one row (source, n, source_size) per source.

    All words are shared out by weight; a source that would get more than ``most`` times its
    size gets just that and the others share the rest. The sources that stop are those of
    the smallest size per weight. Along that order the common level is the first that does not
    exceed the limit of its source; levels fall from there on.
    """
    named = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    limit = F.col("source_size") * float(most) / F.col("weight")
    order = Window.orderBy("limit", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    stopped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * float(most)
    leveled = (
        weighted.withColumn("limit", limit)
        .withColumn("level", (F.sum("source_size").over(every) - stopped) / F.sum("weight").over(after))
    )
    level = F.max(F.when(F.col("level") <= F.col("limit"), F.col("level"))).over(every)
    return leveled.withColumn("common", level).select(
        "source",
        "n",
        "source_size",
        F.least(F.col("source_size") * float(most), F.col("common") * F.col("weight")).alias("target"),
    )


def _place(size: Column) -> Column:
    """Class of a size: its number of digits and its first two."""
    digits = size.cast("string")
    return (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).cast("int")


def mix_sources(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """All rows of ``docs`` with mix_size, mix_source_size, mix_target and mix_copies.

    ``mix_copies`` says how often the mix takes the row: 0 to ``most`` times. Documents stand
    in the order of their size class and, within it, of a hash of their id, so that every
    stretch of a source is taken alike and long texts do not gather by chance. Null is a
    source of its own, the last; null and wordless texts have size 0 and are taken like
    others of their source; a source without any word is not taken. Repeated rows are
    documents of their own. An empty table gives an empty result. Columns of the same
    names are replaced, all others are kept.

    Positions are counted per source, size class and hash prefix first, and only those counts
    are summed up along the source; no source is sorted in one task.
    """
    # A caller's column with the name of a helper is out of the way until the end.
    taken = [c for c in docs.columns if c in HELPERS]
    aside = dict(zip(taken, unused_names(docs.columns, len(taken), "_mix_aside")))
    docs = docs.withColumnsRenamed(aside)
    id, text, source = (aside.get(c, c) for c in (id, text, source))
    sized = docs.withColumn("mix_size", word_count(F.col(text))).withColumns(
        {"_place": _place(F.col("mix_size")), "_order": F.coalesce(F.md5(F.col(id).cast("string")), F.lit("g"))}
    )
    sized = sized.withColumns({"_part": F.substring("_order", 1, 2), "_source": F.col(source), "_tie": F.xxhash64(text)})
    cells = sized.groupBy("_source", "_place", "_part").agg(
        F.count("*").alias("_n"), F.sum("mix_size").alias("_size")
    )
    along = Window.partitionBy("_source").orderBy("_place", "_part")
    goals = targets(
        cells.groupBy(F.col("_source").alias("source")).agg(
            F.sum("_n").alias("n"), F.sum("_size").alias("source_size")
        ),
        weights,
        most,
    )
    goals = goals.select(
        F.col("source").alias("_goal"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target")
    )
    counted = cells.withColumn("_before", F.sum("_n").over(along) - F.col("_n"))
    starts = counted.join(goals, counted["_source"].eqNullSafe(goals["_goal"])).select(
        F.col("_source").alias("_s"), F.col("_place").alias("_p"), F.col("_part").alias("_q"),
        "_before", "mix_source_size", "mix_target",
    )
    own = ["mix_source_size", "mix_target"]
    placed = sized.drop(*own, "mix_copies").join(
        starts,
        sized["_source"].eqNullSafe(starts["_s"])
        & (sized["_place"] == starts["_p"])
        & (sized["_part"] == starts["_q"]),
    )
    rank = Window.partitionBy("_source", "_place", "_part").orderBy("_order", "_tie")
    expected = F.when(F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")).otherwise(0.0)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "/"), F.coalesce("_source", F.lit("")))), 1, 8), 16, 10).cast("double") / float(1 << 32)
    position = F.col("_before") + F.row_number().over(rank)
    crossed = F.floor(position * expected + offset) - F.floor((position - 1) * expected + offset)
    mixed = placed.withColumn("mix_copies", crossed.cast("long")).drop(*HELPERS)
    return mixed.withColumnsRenamed({new: old for old, new in aside.items()})


def repeat_copies(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it."""
    (number,) = unused_names(mixed.columns, 1, "_copy")
    return (
        mixed.filter("mix_copies > 0")
        .withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), "mix_copies")))
        .drop(number)
    )
