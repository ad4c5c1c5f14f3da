"""Catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.scalar import month_floor
from martflow.operators.conform import align, present
from martflow.sources.files import read_seed


def replace_table(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Create or replace a table from a result; with a path its files are kept there."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def reload_seed(
    spark: SparkSession, csv_path: str, schema: T.StructType | str, table: str, path: str | None = None
) -> DataFrame:
    """Replace a table by the full content of its seed file."""
    return replace_table(read_seed(spark, csv_path, schema), table, path)


def create_if_absent(
    spark: SparkSession, table: str, build: Callable[[], DataFrame], path: str | None = None
) -> bool:
    """Create a table unless it exists. An existing one is not even planned. Returns whether it was created."""
    if spark.catalog.tableExists(table):
        return False
    replace_table(build(), table, path)
    return True


def create_all_if_absent(spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]]) -> list[str]:
    """Create those of the tables that do not exist; returns their names."""
    return [table for table, build in builders.items() if create_if_absent(spark, table, build)]


@contextmanager
def temporary_view(df: DataFrame, name: str) -> Iterator[str]:
    """A named intermediate result that is gone afterwards."""
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def append_evolving(
    df: DataFrame,
    table: str,
    date_column: str,
    cluster_by: Sequence[str],
    path: str | None = None,
    month_column: str = "planting_month",
) -> DataFrame:
    """Append to a table partitioned by month and sorted by keys, letting its schema grow.

    Columns new to the table are added to it, and earlier rows read as null there. Columns the frame lacks
    become null. Every column but the partition is nullable. Rows are rebalanced by month, so a hot month is
    written by several tasks.
    """
    spark = df.sparkSession
    incoming = df.withColumn(month_column, F.date_format(month_floor(date_column), "yyyy-MM"))
    keys = present(incoming, cluster_by)
    laid_out = incoming.hint("rebalance", F.col(month_column)).sortWithinPartitions(month_column, *keys)
    if not spark.catalog.tableExists(table):
        writer = laid_out.write.partitionBy(month_column)
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
        return spark.table(table)
    known = set(spark.table(table).columns)
    added = [f for f in incoming.schema.fields if f.name not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    align(laid_out, spark.table(table).schema).write.insertInto(table)
    return spark.table(table)
