"""Exact medians that never gather a group in one task (AGG-4, OP-11).

A group of more than ``cut`` values is divided into ranges: a quantile sketch of its
values gives the boundaries, so that the ranges hold about equally many values however
close together these lie. The ranges are counted, a running sum over them finds the
range that holds the median, and only the values of that range are sorted. With a
``depth`` above 1 a range that is still long is divided again.

Medians are divided as the rows come, and only the values of the range that holds the
median are counted one by one. Weighted medians are counted per value first, partly
before the exchange, which spreads a hot group over its values.

Values are compared as doubles: whole numbers are exact up to 2^53.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Distinct values of a group that one task sorts without dividing the group, for weighted medians.
SORTED_VALUES = 1_000_000
#: The same for medians, in rows that are not counted yet.
UNDIVIDED_ROWS = 100_000
#: A group is divided into SPLITS * SPLITS ranges.
SPLITS = 32
#: Highest number of a range.
MOST_RANGES = SPLITS * SPLITS
#: Steps of the search for a range: halves of the boundaries, and one for the values above the last.
HALVINGS = [*[MOST_RANGES >> i for i in range(1, MOST_RANGES.bit_length())], 1]


def range_bounds(values: DataFrame, keys: Sequence[str], cut: int) -> DataFrame:
    """Boundaries, in order, of the groups with more than ``cut`` rows: (keys, _bounds).

    There are at most rows / cut such groups, with MOST_RANGES boundaries each.
    """
    number = F.col("_value").cast("double")
    known = F.when(~F.isnan(number), number)
    ranks = F.array(*[F.lit(i / MOST_RANGES) for i in range(1, MOST_RANGES + 1)])
    return (
        values.groupBy(*keys)
        .agg(F.count("_value").alias("_known"), F.percentile_approx(known, ranks, 4 * MOST_RANGES).alias("_bounds"))
        .filter(F.col("_known") > cut)
        .select(*keys, F.coalesce("_bounds", F.array().cast("array<double>")).alias("_bounds"))
    )


def range_number(value: Column, bounds: Column) -> Column:
    """Number of the boundaries below the value, which orders like the value; null for null.

    NaN comes after all boundaries. Without boundaries every value has the number 0.
    """
    value = value.cast("double")
    steps = F.array(*[F.lit(step) for step in HALVINGS])

    def further(at: Column, step: Column) -> Column:
        return at + F.when(F.get(bounds, at + step - 1) < value, step).otherwise(0)

    return F.when(value.isNotNull(), F.when(bounds.isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), further)))


def _on(keys: Sequence[str]) -> Column:
    matching = F.lit(True)
    for k in keys:
        matching = matching & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    return matching


def _joined(values: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on the keys; null keys match each other. Spark broadcasts ``other`` where it is small."""
    renamed = other.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys], *[c for c in other.columns if c not in keys]
    )
    return values.join(renamed, _on(keys), how).drop(*[f"_at_{k}" for k in keys])


def _with_ranges(values: DataFrame, keys: Sequence[str], name: str, cut: int) -> DataFrame:
    """Number of the range of each value within its group; ``_divided`` tells the groups with boundaries.

    The boundaries are broadcast: a group that has some has more than ``cut`` rows.
    """
    bounded = _joined(values, F.broadcast(range_bounds(values, keys, cut)), keys, "left")
    number = range_number(F.col("_value"), F.col("_bounds"))
    return bounded.withColumns({name: number, "_divided": F.col("_bounds").isNotNull()}).drop("_bounds")


def _frames(keys: Sequence[str], order: str) -> tuple[WindowSpec, WindowSpec, WindowSpec]:
    """Rows up to the current one, rows before it, all rows: one sort for the three."""
    ordered = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_first())
    start, end = Window.unboundedPreceding, Window.unboundedFollowing
    return (
        ordered.rowsBetween(start, Window.currentRow),
        ordered.rowsBetween(start, -1),
        ordered.rowsBetween(start, end),
    )


def grouped_medians(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    levels: Sequence[Sequence[str]] | None = None,
    weight: str | None = None,
    lowest: Sequence[str] = (),
    highest: Sequence[str] = (),
    cut: int = UNDIVIDED_ROWS,
    depth: int = 1,
) -> DataFrame:
    """Exact median of each measure per group, for one or several grouping levels.

    Returns the keys, ``level`` (position in ``levels``), one double column per
    measure (mean of the two middle values, nulls skipped) and ``rows``, the group
    size with nulls included. ``weight`` names a column of row counts for input
    that is already aggregated. Keys outside a level are null, as are null keys:
    tell them apart by ``level``. The minima of the columns ``lowest`` and the maxima
    of the columns ``highest`` come along under their names.

    Groups of more than ``cut`` values are divided before anything is counted per value: what
    a task keeps of them is one row per range, and only the range of the median is counted
    per value, exchanged and sorted.
    """
    levels = [list(level) for level in (levels or [keys])]
    extremes = {**dict.fromkeys(lowest, F.min), **dict.fromkeys(highest, F.max)}
    group = [*keys, "_level", "_measure"]
    found = _per_level_and_measure(df, keys, measures, levels, weight, list(extremes))

    def middle_of(is_filled: Column) -> Column:
        low, high = F.expr("(_filled + 1) div 2"), F.expr("_filled div 2 + 1")
        held = (F.col("_upto") >= low) & (F.col("_upto") - F.col("_n") < high)
        return (F.col("_filled") == 0) | (is_filled & held)

    def totals(is_filled: Column, whole: WindowSpec) -> dict[str, Column]:
        return {
            "_rows": F.sum("_n").over(whole),
            "_filled": F.sum(F.when(is_filled, F.col("_n")).otherwise(0)).over(whole),
            "_before": F.lit(0).cast("bigint"),
            **{f"_all_{c}": extreme(f"_{c}").over(whole) for c, extreme in extremes.items()},
        }

    known = ["_rows", "_filled", "_before", *[f"_all_{c}" for c in extremes]]
    least = [extreme(f"_{c}").alias(f"_{c}") for c, extreme in extremes.items()]
    scope = group
    for level in range(depth):
        bucket = f"_range{level}"
        found = _with_ranges(found, scope, bucket, cut)
        is_filled = F.col(bucket).isNotNull()
        filled = F.when(is_filled, F.col("_n")).otherwise(0)
        so_far, _, whole = _frames(scope, bucket)
        carried = [F.max(c).alias(c) for c in known] if level else least
        counted = found.filter("_divided").groupBy(*scope, bucket).agg(F.sum("_n").alias("_n"), *carried)
        if not level:
            counted = counted.withColumns(totals(is_filled, whole))
        targets = (
            counted.withColumn("_upto", F.col("_before") + F.sum(filled).over(so_far))
            .filter(middle_of(is_filled))
            .withColumn("_before", F.col("_upto") - filled)
            .select(*scope, bucket, *[F.col(c).alias(f"_new{c}") for c in known], F.lit(True).alias("_target"))
        )
        # A group that is not divided stays together, with its nulls.
        found = found.withColumn(bucket, F.when(F.col("_divided"), F.col(bucket)).otherwise(0))
        scope = [*scope, bucket]
        found = _joined(found, F.broadcast(targets), scope, "left").filter(~F.col("_divided") | F.col("_target"))
        now = {c: F.coalesce(f"_new{c}", c) if level else F.col(f"_new{c}") for c in known}
        found = found.withColumns(now).drop("_divided", "_target", *[f"_new{c}" for c in known])

    in_order, _, whole = _frames(scope, "_value")
    is_filled = F.col("_value").isNotNull()
    filled = F.when(is_filled, F.col("_n")).otherwise(0)
    counted = found.groupBy(*scope, "_value").agg(F.sum("_n").alias("_n"), *[F.max(c).alias(c) for c in known], *least)
    whole_group = {c: F.coalesce(F.col(c), total) for c, total in totals(is_filled, whole).items()}
    middle = (
        counted.withColumns(whole_group)
        .withColumn("_upto", F.col("_before") + F.sum(filled).over(in_order))
        .filter(middle_of(is_filled))
    )
    medians = []
    for number, measure in enumerate(measures):
        value = F.when(F.col("_measure") == number, F.col("_value"))
        medians.append(((F.min(value) + F.max(value)) / 2).alias(measure))
    return (
        middle.groupBy(*keys, "_level")
        .agg(
            *medians,
            F.max("_rows").alias("rows"),
            *[F.max(f"_all_{c}").alias(c) for c in extremes],
        )
        .withColumnRenamed("_level", "level")
    )


def _per_level_and_measure(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    levels: Sequence[Sequence[str]],
    weight: str | None,
    extremes: Sequence[str],
) -> DataFrame:
    """Each row once per level and measure: (keys, _level, _measure, _value, _n, extremes)."""
    number = F.col(weight) if weight else F.lit(1).cast("bigint")
    copies = [
        F.struct(
            *[F.when(F.lit(k in level), F.col(k)).alias(k) for k in keys],
            F.lit(at).alias("_level"),
            F.lit(which).alias("_measure"),
            F.col(measure).cast("double").alias("_value"),
        )
        for at, level in enumerate(levels)
        for which, measure in enumerate(measures)
    ]
    return df.select(
        F.inline(F.array(*copies)), number.alias("_n"), *[F.col(c).alias(f"_{c}") for c in extremes]
    )


def weighted_median(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    cut: int = SORTED_VALUES,
    depth: int = 1,
) -> DataFrame:
    """Weighted median per group: keys and ``value``.

    Rows ordered by value (nulls first), ties by weight, have the position
    ``(running weight - weight / 2) / total weight``; the value of the first row at
    or past 0.5 is the result. Rows without a weight count for nothing and are never
    chosen; groups without any weight give no row. Weights must not be negative.

    Positions never fall along the order. The last row of a value, its heaviest,
    therefore decides for the whole value, and the sum and maximum of the weights
    per value are enough. ``cut`` as in ``grouped_medians``.
    """
    keys, outer = [*keys, "_all"], list(keys)
    found = (
        df.withColumn("_all", F.lit(0))
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.sum(weight).alias("_weight"), F.max(weight).alias("_last"))
    )

    def reached(upto: Column, last: str) -> Column:
        position = F.try_divide(upto - F.col(last) / 2, F.col("_total"))
        return F.coalesce(position >= 0.5, F.lit(False))

    # The weight of the last weighted row of a range; max_by skips a null order,
    # the null range has a single value.
    weighted_value = F.when(F.col("_last").isNotNull(), F.col("_value"))
    last_weight = F.coalesce(F.max_by("_last", weighted_value), F.max("_last"))
    before = F.col("_upto") - F.coalesce(F.col("_weight"), F.lit(0))
    reached_here = reached(F.col("_upto"), "_last") & ~reached(before, "_last_before")

    scope = keys
    for level in range(depth):
        bucket = f"_range{level}"
        found = _with_ranges(found, scope, bucket, cut).drop("_divided")
        so_far, earlier, whole = _frames(scope, bucket)
        carried = [] if scope == keys else [F.max(c).alias(c) for c in ("_total", "_before")]
        counted = found.groupBy(*scope, bucket).agg(
            F.sum("_weight").alias("_weight"), last_weight.alias("_last"), *carried
        )
        if scope == keys:
            counted = counted.withColumns(
                {"_total": F.sum("_weight").over(whole), "_before": F.lit(0)}
            )
        scope = [*scope, bucket]
        targets = (
            counted.withColumns(
                {
                    "_upto": F.col("_before") + F.sum("_weight").over(so_far),
                    "_last_before": F.last("_last", ignorenulls=True).over(earlier),
                }
            )
            .filter(reached_here)
            .select(*scope, "_total", before.alias("_before"))
        )
        found = _joined(found.drop("_total", "_before"), targets, scope, "inner")

    in_order, _, _ = _frames(scope, "_value")
    # Should rounding of fractional weights hide the crossing seen for the range,
    # its last weighted value is the one.
    chosen = F.coalesce(
        F.min(F.when(reached(F.col("_upto"), "_last"), F.col("_value"))),
        F.max(F.when(F.col("_last").isNotNull(), F.col("_value"))),
    )
    running = F.coalesce(F.sum("_weight").over(in_order), F.lit(0))
    return (
        found.withColumn("_upto", F.col("_before") + running)
        .groupBy(*outer)
        .agg(chosen.alias(value))
    )
