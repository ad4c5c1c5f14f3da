"""File sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class WriteFailed(Exception):
    """Some tables could not be written."""


def write_tables(
    tables: Mapping[str, DataFrame], prefix: str, mode: str = "overwrite", at_once: int = 4, **options: str
) -> dict[str, str]:
    """Write each table to its own directory, several at once so that small ones leave no executor idle.

    All are tried; failures are raised together at the end. ``options`` are those of the Parquet writer.
    """
    paths = {name: f"{prefix}/{name}" for name in tables}
    failed = {}
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        writes = {
            name: pool.submit(df.write.mode(mode).options(**options).parquet, paths[name])
            for name, df in tables.items()
        }
        for name, write in writes.items():
            error = write.exception()
            if error is not None:
                failed[name] = error
    if failed:
        raise WriteFailed("; ".join(f"{name}: {error}" for name, error in failed.items())) from next(
            iter(failed.values())
        )
    return paths


def write_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write a table partitioned by columns, replacing only the partitions that the frame holds.

    Rows are rebalanced by partition value: adaptive execution merges small partitions into one file and splits
    a hot one over several tasks. Sorting inside the files lets scans skip row groups by key.
    """
    laid_out = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        laid_out = laid_out.sortWithinPartitions(*partition_by, *sort_by)
    (
        laid_out.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def as_messages(df: DataFrame, key: Column | str) -> DataFrame:
    """Rows as keyed JSON messages, ready for a topic or a text directory."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def publish(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Write message values to a landing directory, one per line."""
    messages.select("value").write.mode(mode).text(path)


def publish_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Write keyed messages to a Kafka topic; needs the connector on the classpath."""
    messages.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic}).save()
