"""Annual series: splicing, interpolation by a reference, year labels (OP-12, 13, 23, 25)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from parcelstats.functions import lenient_long, rounded_long, year_prefix
from parcelstats.operators.quantiles import MOST_RANGES, range_bounds, range_number
from parcelstats.reference_data import REFERENCE_SWITCH_YEAR

#: Positions of a reference series that are filled in one go.
SEGMENT = 10_000


def splice_series(
    before: DataFrame,
    after: DataFrame,
    switch: int = REFERENCE_SWITCH_YEAR,
    position: str = "year",
) -> DataFrame:
    """``before`` up to the switch position, ``after`` from it on."""
    return before.filter(F.col(position) < switch).unionByName(
        after.filter(F.col(position) >= switch)
    )


def normalise_year_ranges(df: DataFrame, column: str = "year") -> DataFrame:
    """``"2011-2015"`` becomes ``"2015"``; plain years stay, other ranges become null."""
    text = F.col(column)
    last_year = F.nullif(F.regexp_extract(text, "-([0-9]+)$", 1), F.lit(""))
    return df.withColumn(column, F.when(text.contains("-"), last_year).otherwise(text))


def annual_reference_income(df: DataFrame) -> DataFrame:
    """(year, median_household_income) from dated text; unreadable incomes become null."""
    return df.select(
        year_prefix("observation_date").alias("year"),
        lenient_long("median_household_income").alias("median_household_income"),
    )


def interpolate_by_reference(
    df: DataFrame,
    reference: DataFrame,
    column: str,
    group: str = "region",
    position: str = "year",
    segment: int = SEGMENT,
) -> DataFrame:
    """Fill ``column`` for every group and position along a reference series.

    The ratio of the group's value to the reference is known where both exist. It is
    interpolated linearly between known positions, kept constant outside them, and
    multiplied with the reference; positions without a reference row drop out, and
    so do not even take part: a ratio is known only where the reference is.

    Positions are numbers; a position that ``reference`` repeats fails the query. A reference
    of more than ``segment`` positions is cut into ranges of about equally many, and each group
    is filled range by range: the last ratio known before a range and the first one after
    it come from one row per group and range, so that no task needs a whole group.
    """
    placed = reference.filter(F.col(position).isNotNull())
    message = F.concat(F.lit("more than one reference for "), F.col(position).cast("string"))
    single = F.when(F.count("*") == 1, F.max(column)).otherwise(F.raise_error(message))
    along = placed.groupBy(position).agg(single.alias("_reference"))

    cuts = range_bounds(placed.select(F.col(position).alias("_value")), [], segment)
    cuts = cuts.select("_bounds").scalar()
    number = range_number(F.col(position), F.col("_cuts"))
    last = F.when(cuts.isNull(), 0).otherwise(MOST_RANGES)

    along = along.withColumn("_cuts", cuts).withColumn("_segment", number).drop("_cuts")
    blocks = along.groupBy("_segment").agg(
        F.collect_list(F.struct(position, "_reference")).alias("_places")
    )
    values = df.select(group, position, F.col(column).cast("double").alias("_value"))
    ratio = F.try_divide(F.col("_value"), F.col("_reference").cast("double"))
    known = values.join(along, position).select(group, position, "_segment", ratio.alias("_ratio"))
    ends = (
        known.filter(F.col("_ratio").isNotNull())
        .groupBy(group, "_segment")
        .agg(
            F.min(position).alias("_first_at"),
            F.min_by("_ratio", position).alias("_first"),
            F.max(position).alias("_last_at"),
            F.max_by("_ratio", position).alias("_last"),
        )
    )
    cells = (
        df.select(group).distinct()
        .withColumn("_segment", F.explode(F.sequence(F.lit(0), last)))
        .join(ends, [group, "_segment"], "left")
    )
    earlier = Window.partitionBy(group).orderBy(F.col("_segment").asc())
    later = Window.partitionBy(group).orderBy(F.col("_segment").desc())
    cells = cells.select(
        group,
        "_segment",
        _latest(F.col("_last"), earlier, -1).alias("_before"),
        _latest(F.col("_last_at"), earlier, -1).alias("_before_at"),
        _latest(F.col("_first"), later, -1).alias("_after"),
        _latest(F.col("_first_at"), later, -1).alias("_after_at"),
    )
    grid = (
        cells.join(blocks, "_segment")
        .withColumn("_place", F.explode("_places"))
        .select("*", "_place.*")
        .drop("_places", "_place")
    )

    # Two running windows in opposite directions: a frame that looks ahead to the
    # end would be evaluated anew for every row.
    known_position = F.when(F.col("_ratio").isNotNull(), F.col(position))
    back = Window.partitionBy(group, "_segment").orderBy(F.col(position).asc())
    ahead = Window.partitionBy(group, "_segment").orderBy(F.col(position).desc())
    filled = (
        grid.join(values, [group, position], "left")
        .withColumn("_ratio", ratio)
        .withColumns(
            {
                "_left": F.coalesce(_latest(F.col("_ratio"), back), "_before"),
                "_left_at": F.coalesce(_latest(known_position, back), "_before_at"),
                "_right": F.coalesce(_latest(F.col("_ratio"), ahead), "_after"),
                "_right_at": F.coalesce(_latest(known_position, ahead), "_after_at"),
            }
        )
        .withColumn("_filled", _lerp(position))
    )
    value = rounded_long(F.col("_filled") * F.col("_reference"))
    return filled.select(position, group, value.alias(column))


def _latest(value: Column, window: WindowSpec, until: int = Window.currentRow) -> Column:
    frame = window.rowsBetween(Window.unboundedPreceding, until)
    return F.last(value, ignorenulls=True).over(frame)


def _lerp(position: str) -> Column:
    share = F.try_divide(F.col(position) - F.col("_left_at"), F.col("_right_at") - F.col("_left_at"))
    between = F.col("_left") + (F.col("_right") - F.col("_left")) * share
    return F.coalesce(F.col("_ratio"), between, F.col("_left"), F.col("_right"))
