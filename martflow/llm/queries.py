"""The operators over the given tables, each with SQL that gives the same rows where there is some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import ann, bpe, exact, language, near, negatives, packing, pages, pii, quality, secret_scan, shards, spelling
from martflow.llm.common import held_out, read
from martflow.llm.sql import EXACT_DEDUP, HARD_NEGATIVES, HILBERT_SHARDS, SPELLING

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op6_exact_dedup", EXACT_DEDUP)
def op6_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    found = exact.exact_duplicates(read(spark, directory, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        F.col("keep_key").alias("keep_id"),
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


@query("op8_hilbert_shards", HILBERT_SHARDS)
def op8_hilbert_shards(spark: SparkSession, directory: str) -> DataFrame:
    placed = shards.shards(read(spark, directory, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op9_pattern_packing")
def op9_pattern_packing(spark: SparkSession, directory: str) -> DataFrame:
    docs = read(spark, directory, "documents")
    cut = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(narrow, ["doc_id", "piece"])


@query("op10_forced_boundary_bpe")
def op10_forced_boundary_bpe(spark: SparkSession, directory: str) -> DataFrame:
    encoded = bpe.encode(read(spark, directory, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op7_bbit_minhash")
def op7_bbit_minhash(spark: SparkSession, directory: str) -> DataFrame:
    return near.near_duplicates(read(spark, directory, "documents"))


@query("op1_language_id")
def op1_language_id(spark: SparkSession, directory: str) -> DataFrame:
    docs = read(spark, directory, "documents")
    found = language.predict(docs, language.train(docs))
    return found.select(F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "lang_pred", "score", "rejected")


@query("op2_boosted_quality")
def op2_boosted_quality(spark: SparkSession, directory: str) -> DataFrame:
    docs, labels = read(spark, directory, "documents"), read(spark, directory, "labels")
    return quality.scored(docs, labels).select(
        F.col("key").alias("doc_id"),
        held_out(F.col("key")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _listed(column: str):
    parts = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def _count_of(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@query("op3_crf_pii")
def op3_crf_pii(spark: SparkSession, directory: str) -> DataFrame:
    """The counts are those of the base spans; ``spans`` holds the added ones too."""
    found = pii.spans(read(spark, directory, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        *[_count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


@query("op4_learned_partitions")
def op4_learned_partitions(spark: SparkSession, directory: str) -> DataFrame:
    return ann.nearest(read(spark, directory, "embeddings"))


@query("op5_wrapper_induction")
def op5_wrapper_induction(spark: SparkSession, directory: str) -> DataFrame:
    found = pages.main_texts(read(spark, directory, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query("op13_four_russians", HARD_NEGATIVES)
def op13_four_russians(spark: SparkSession, directory: str) -> DataFrame:
    return negatives.hard_negatives(read(spark, directory, "embeddings"))


@query("op12_assignment_lexing")
def op12_assignment_lexing(spark: SparkSession, directory: str) -> DataFrame:
    """The counts are those of the base spans; ``spans`` holds the added ones too."""
    found = secret_scan.spans(read(spark, directory, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        *[_count_of(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


@query("op11_kd_spelling", SPELLING)
def op11_kd_spelling(spark: SparkSession, directory: str) -> DataFrame:
    return spelling.variants(read(spark, directory, "documents"))
