"""The registered queries of this package: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstats.llm import bpe, language_model, oracle, quality, rules, warc
from parcelstats.llm.centroids import cluster_vectors
from parcelstats.llm.hard_negatives import mine_hard_negatives
from parcelstats.llm.licenses import scan_licenses
from parcelstats.llm.mixing import mix_sources
from parcelstats.llm.near_texts import link_near_texts
from parcelstats.llm.near_vectors import link_near_vectors
from parcelstats.llm.secrets import scan_secrets
from parcelstats.llm.toxicity import fit_toxicity, training_part

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_near_vectors(table(spark, sf_dir, "embeddings"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_near_texts(table(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), with_decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return model.score(docs, to="score").select(
        "doc_id",
        (~quality.training_part(F.col("doc_id"))).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return model.score(docs, to="score").select(
        "doc_id",
        (~training_part(F.col("doc_id"))).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = language_model.score_texts(table(spark, sf_dir, "documents"))
    return scored.withColumn("held_out", ~language_model.training_part(F.col("doc_id")))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents stand in a folder per source, language and hundred of ids, some of them higher up."""
    id = F.col("doc_id")
    folder = F.when(id % 97 == 0, F.col("source")).when(id % 11 == 0, F.concat_ws("/", "source", "lang"))
    group = F.concat_ws("/", "source", "lang", F.expr("cast(doc_id div 100 as string)"))
    path = F.concat_ws("/", F.coalesce(folder, group), id.cast("string"))
    files = table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    return scan_licenses(files).select("doc_id", "license", "license_cosine", "license_from")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = scan_secrets(docs).select("doc_id", F.posexplode("findings").alias("place", "f"))
    return found.select(
        "doc_id",
        "place",
        F.sha2("f.value", 256).alias("value_sha256"),
        F.length("f.value").alias("length"),
        "f.score",
        "f.secret",
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.col("quality").alias("posterior"),
    )


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op12_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives written, every page looked up in their index, and its record read."""
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(pages)
    captures = warc.fetch(archives, warc.look_up(archives, pages))
    return captures.select(
        F.col("page").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("kind").alias("record_type"),
        "refers_to",
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_near_dedup,
        op2_minhash_near_dedup,
        op3_bpe_round_trip,
        op4_quality_classifier,
        op5_toxicity,
        op6_language_model,
        op7_license_scan,
        op8_mix_sources,
        op9_secret_scan,
        op10_quality_rules,
        op11_centroid_clusters,
        op12_warc_round_trip,
        op13_hard_negatives,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op7_license_scan": oracle.OP7,
    "op8_mix_sources": oracle.OP8,
    "op11_centroid_clusters": oracle.OP11,
    "op12_warc_round_trip": oracle.OP12,
    "op13_hard_negatives": oracle.OP13,
}
