"""Exact duplicates by a tree-merge of sorted digest runs.

Every partition turns its texts into one run of digests, sorted, each with the identifier that stays and a count.
The partitions then exchange runs in binomial rounds: ranks are numbers of ``rounds`` digits, and in round r a rank
deals its run to the ranks that differ from it in digit r alone, by digit r of the digest. Each rank merges the
few runs it receives and keeps one row per digest, so a digest held by every partition arrives at most once from
each partner. After the last round a rank holds all there is of its digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.workspace import materialise

# Runs merged at once by a rank.
FAN_IN = 8


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the SHA-256 of the whole text (null counts as empty), its length, and a short sort digest."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("key"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("sha"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        F.xxhash64(content).alias("digest"),
    )


def local_runs(rows: DataFrame, ranks: int) -> DataFrame:
    """One run per partition: each distinct digest once, with the row that stays and a count.

    Grouping by the partition's own rank combines a partition's copies before anything is sent.
    """
    return _merged(rows.withColumn("rank", F.spark_partition_id() % ranks).withColumn("n", F.lit(1)))


def _merged(runs: DataFrame) -> DataFrame:
    """One row per rank and digest. Rows of one short digest that differ in SHA-256 or length are other texts."""
    # The largest key stays, any key before a missing one; of rows that repeat it, the first.
    first = F.struct("key", -F.col("row"))
    return runs.groupBy("rank", "digest", "sha", "n_bytes").agg(
        F.max_by("key", first).alias("key"), F.max_by("row", first).alias("row"), F.sum("n").alias("n")
    )


def merge_tree(runs: DataFrame, ranks_per_digit: int, rounds: int) -> DataFrame:
    """Merge the runs in ``rounds`` exchanges; one row per digest is left, verified by SHA-256 and length."""
    ranks = ranks_per_digit**rounds
    for step in range(rounds):
        place = ranks_per_digit**step
        mine = F.floor(F.col("rank") / place) % ranks_per_digit
        wanted = F.floor(F.pmod(F.col("digest"), F.lit(ranks)) / place) % ranks_per_digit
        dealt = runs.withColumn("rank", (F.col("rank") + (wanted - mine) * place).cast("int"))
        runs = _merged(dealt.repartitionById(ranks, F.col("rank")).sortWithinPartitions("rank", "digest", "sha", "n_bytes"))
    return runs


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """One row per row of ``docs``: key, keep_key, group_size, kept, sha.

    Texts are equal when all their bytes are; null counts as empty. Of equal texts the row with the largest
    key stays, any key before a null one, and of rows that repeat that key exactly one. An empty table gives an
    empty result. Only ``key`` and ``text`` are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    stored = materialise(digests(docs, key, text).withColumn("row", F.monotonically_increasing_id()), "digests")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rounds = 1
    while fan_in**rounds < parts:
        rounds += 1
    groups = materialise(merge_tree(local_runs(stored, fan_in**rounds), fan_in, rounds), "digest-groups")
    # One row per digest on the right. A digest that many rows share is split by the adaptive skew join.
    repeated = groups.where("n > 1").select("digest", "sha", F.col("key").alias("keep"), F.col("row").alias("first"), "n")
    joined = stored.join(repeated, ["digest", "sha"], "left")
    return joined.select(
        "key",
        F.when(F.col("n").isNull(), F.col("key")).otherwise(F.col("keep")).alias("keep_key"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("first"))).alias("kept"),
        "sha",
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of every group of equal texts."""
    decided = exact_duplicates(docs, key, text)
    winners = (
        decided.where(F.col("key").eqNullSafe(F.col("keep_key")))
        .groupBy(F.col("key").alias("_llm_key"), F.col("sha").alias("_llm_sha"))
        .agg(F.count("*").alias("_llm_rows"))
    )
    sha = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    kept = docs.withColumn("_llm_own", sha).join(
        winners, F.col(key).eqNullSafe(F.col("_llm_key")) & (F.col("_llm_own") == F.col("_llm_sha"))
    )
    # A winner that is there twice, as a repeated row, stays once.
    once = kept.where("_llm_rows = 1").unionByName(
        kept.where("_llm_rows > 1").dropDuplicates(["_llm_key", "_llm_sha"])
    )
    return once.select(*docs.columns)
