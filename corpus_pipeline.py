"""A corpus made ready for training, in five stages over the table of documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next stage's documents. All stages but the last return the columns of
documents and work on every row that the stage before has kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstats.llm import bpe, mixing, near_texts, secrets, toxicity
from parcelstats.llm.tables import settle

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels)
    scored = model.score(docs.select(*COLUMNS), to="_toxicity")
    return scored.filter("_toxicity < 0.3").select(*COLUMNS)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, the one with the smallest id.

    Decided row by row: of rows that repeat an id, those with texts of their own stay, and of
    copies that share an id one does. Rows without an id come last in their group; texts
    without words are in no group and stay.
    """
    rows = settle(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")
    found = near_texts.link_near_texts(rows.select(place.alias("place"), "text"), id="place")
    gone = found.filter("not kept").select(F.col("place._row").alias("_row"))
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays."""
    scanned = secrets.scan_secrets(docs.select(*COLUMNS))
    text = secrets.redacted(F.col("text"), F.col("findings"))
    return scanned.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat_copies(mixing.mix_sources(docs.select(*COLUMNS))).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token numbers of each document (little-endian unsigned 32-bit integers)."""
    return bpe.encode(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one_of_copies),
    ("secrets", redact_secrets),
    ("mixing", mix),
    ("tokens", tokenize),
]

#: A learned lexicon, a forest and BPE cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
