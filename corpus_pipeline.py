"""A pipeline over ``documents``: language ID, exact and near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before has kept, and returns the columns of the
documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import exact, language, near, packing, pii
from martflow.llm.common import read, session
from martflow.workspace import materialise

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told, and named if they had no name. Those that are rejected go.

    Rejected is what has no letter, a score below the calibrated threshold, or too few subwords that the sample knows, as
    gibberish, code and languages that were not learnt. The decision depends on the text alone, so
    it is made once for each row and carried next to it.
    """
    session(spark)
    return language.with_language(docs, language.train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    session(spark)
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.75 or more, the one with the smallest doc_id stays."""
    session(spark)
    gone = near.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("_llm_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_llm_gone"), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its personal data replaced by the kind in brackets and n_chars brought up to date."""
    session(spark)
    return pii.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences of 1024 tokens."""
    session(spark)
    cut = packing.pieces(docs, public_tokenizers.path(TOKENIZER))
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(narrow, ["doc_id", "piece"])


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packed),
]

# Trained and iterative stages are beyond SQL; the tests hold the duplicates, personal data and packing against brute force,
# language_id against planted cases and held-out rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
