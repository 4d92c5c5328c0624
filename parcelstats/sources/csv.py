"""CSV with normalised column names (SRC-1..4) and the result writer (SNK-1)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Text replaced by an underscore in column names, in this order.
NAME_SEPARATORS = [" / ", " ", "\n", "/"]


def normalise_name(name: str) -> str:
    for separator in NAME_SEPARATORS:
        name = name.strip().replace(separator, "_")
    return name.lower()


def normalise_columns(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Rename all columns and keep the wanted ones; unknown wanted names are ignored."""
    renamed = {name: normalise_name(name) for name in df.columns}
    kept = {old: new for old, new in renamed.items() if not columns or new in columns}
    if len(set(kept.values())) < len(kept):
        raise ValueError(f"column names collide after normalisation: {sorted(kept.values())}")
    return df.select(*[F.col(f"`{old.replace('`', '``')}`").alias(new) for old, new in kept.items()])


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
    multi_line: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """Header CSV files as strings, or leniently cast to ``types``.

    A value that does not fit its type becomes null. Lines with too many fields lose the
    extra ones, short lines are filled with nulls. ``multi_line`` allows line breaks in
    quotes, at the price of one task per file. Use ``infer_types`` for types that follow from
    all values.

    All files of a path must have the same header, and a file with another one fails the
    query. ``by_name`` allows files with other columns or another order: their headers
    are read first, a short job per file, files of one header are read together, and columns
    match by their normalised names; a column that a file lacks is null in its rows.
    """

    def scan(paths: str | Sequence[str]) -> DataFrame:
        raw = spark.read.csv(
            paths,
            header=True,
            inferSchema=False,
            enforceSchema=False,
            mode="PERMISSIVE",
            escape='"',
            # Stands in for a missing value, so that a quoted empty text stays a text.
            nullValue="\0",
            multiLine=multi_line,
        )
        return normalise_columns(raw, columns)

    if not by_name:
        return with_types(scan(path), types or {})
    files = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(8) as pool:
        headers = list(pool.map(lambda file: tuple(spark.read.csv(file, header=True, escape='"').columns), files))
    same: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers):
        same.setdefault(header, []).append(file)
    parts = [scan(paths) for paths in same.values()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return with_types(rows, types or {})


# Texts that are a whole number, a number, a truth value.
WHOLE = r"^[+-]?[0-9]+$"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
TRUTH = r"^(true|false)$"
DIGITS = r"\A[0-9]*+\z"
# Marks of the types that a text does not have.
NO_WHOLE, NO_NUMBER, NO_TRUTH = 1, 2, 4

#: Columns whose values are looked at together, to see whether they all consist of digits.
COLUMNS_OF_A_GROUP = 8


def infer_types(df: DataFrame) -> dict[str, str]:
    """Types that all values of the text columns have: bigint, double, boolean or string.

    One pass over all rows: every task forms its verdict on each column, and the verdicts are
    combined. Nulls and empty texts fit every type; a column without any value is a string.
    Whole numbers beyond 64 bits make a double. Columns that are no text keep their type.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]
    if not texts:
        return {}
    verdicts = _verdicts(df, texts).first()
    kinds = ((NO_WHOLE, "bigint"), (NO_NUMBER, "double"), (NO_TRUTH, "boolean"))
    found = {}
    for name, verdict in zip(texts, verdicts):
        fitting = (kind for misfit, kind in kinds if verdict is not None and not verdict & misfit)
        found[name] = next(fitting, "string")
    return found


def _verdicts(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """One row with the marks of the types that not all values of a column have, null without any value."""
    values = {f"c{i}": F.col(f"`{name}`") for i, name in enumerate(texts)}
    digits, marks = {}, []
    for k in range(0, len(texts), COLUMNS_OF_A_GROUP):
        group = list(values)[k : k + COLUMNS_OF_A_GROUP]
        digits[f"d{k}"] = F.concat_ws("", *[values[c] for c in group]).rlike(DIGITS)
        marks += [F.bit_or(_misfits(F.col(c), F.col(f"d{k}"))) for c in group]
    columns = {**values, **digits}
    return df.select(*[column.alias(c) for c, column in columns.items()]).agg(*marks)


def _misfits(value: Column, only_digits: Column) -> Column:
    """The types that a text does not have, as the sum of their marks; null for no value.

    ``only_digits`` tells texts of digits alone, for several columns at a time. Up to 18
    characters of a whole number always fit 64 bits. The cast is for longer ones only: it is
    slow where it fails, as are patterns for every value.
    """
    short = F.octet_length(value) <= 18
    fits = short | value.try_cast("bigint").isNotNull()
    return (
        F.when(value == "", None)
        .when(only_digits & short, NO_TRUTH)
        .when(value.rlike(WHOLE), F.when(fits, NO_TRUTH).otherwise(NO_WHOLE + NO_TRUTH))
        .when(value.rlike(NUMBER), NO_WHOLE + NO_TRUTH)
        .when(value.rlike(TRUTH), NO_WHOLE + NO_NUMBER)
        .when(value.isNotNull(), NO_WHOLE + NO_NUMBER + NO_TRUTH)
    )


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    present = {name: F.col(name).try_cast(type_) for name, type_ in types.items() if name in df.columns}
    return df.withColumns(present) if present else df


def write_csv(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> None:
    """Write header CSV, sorted by range partitions when an order is given.

    Small results end up in a single file because adaptive execution merges their
    partitions; large ones stay spread over ordered files.
    """
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_parquet(df: DataFrame, path: str) -> None:
    """Write Parquet, compressed harder than by default: tables of raw extracts have many columns of numbers."""
    options = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
    df.write.mode("overwrite").options(**options).parquet(path)
