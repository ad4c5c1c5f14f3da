"""Helpers shared by the operators: sessions, Arrow maps over whole columns, and numbering at any size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from martflow.session import prepare
from martflow.workspace import materialise

# Rows of one Arrow batch. Texts may be long, so batches are short.
BATCH_ROWS = 256


def session(spark: SparkSession) -> SparkSession:
    """The settings all operators rely on, applied to a session built elsewhere."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return session(spark).read.parquet(f"{directory}/{table}.parquet")


def map_columns(
    df: DataFrame,
    schema: str,
    start: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
) -> DataFrame:
    """Apply a function of whole columns, lists with None for null, to every Arrow batch.

    ``start`` runs once per task and returns the function, so that it can load what the task needs.
    """
    struct: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        apply = None
        for batch in batches:
            if batch.num_rows:
                apply = apply or start()
                yield pa.RecordBatch.from_pydict(apply(batch.to_pydict()), schema=arrow)

    return df.mapInArrow(run, struct)


def in_learning_part(key: Column) -> Column:
    """Rows a model may learn from: all but those whose crc32 of the id as text leaves 1 when divided by 3."""
    return ~held_out(key)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, the same ones in every run: those with the smallest hash of ``key``.

    Larger hashes than the sample can need are left out first, so that no task sends more than its share.
    """
    place = F.xxhash64(F.col(key).cast("string"))
    share = 1.5 * rows / max(1, df.count())
    if share < 1:
        df = df.where(place < int(-(2**63) + 2**64 * share))
    return df.orderBy(place, F.col(key)).limit(rows)


def numbered(df: DataFrame, order: list[str], name: str, label: str) -> DataFrame:
    """Add the row's place in the order, gapless from 0, without a global window.

    The rows are range-partitioned, sorted and stored with their place in the partition; only one count per
    partition is gathered and handed back to all tasks. Equal rows may swap places.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The id holds the partition in its upper bits and the place in the lower 33.
    stored = materialise(spread.withColumn("_id", F.monotonically_increasing_id()), label)
    part = F.shiftright(F.col("_id"), 33)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).collect()
    before, total = {}, 0
    for row in sorted(counts, key=lambda r: r["_part"]):  # one count for each shuffle partition
        before[row["_part"]] = total
        total += row["_rows"]
    starts = spark.createDataFrame(list(before.items()), "_part long, _before long")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id", "_part", "_before")
    )
