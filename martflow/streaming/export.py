"""Incremental export of a lake to a warehouse table that grows with what it is given."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.scalar import month_floor
from martflow.operators.widen import merged, widened
from martflow.sinks.committed import CommittedTable
from martflow.sources.files import PARQUET_GLOB, frames_by_schema

# Partition of the records without a date, and the column of the partitions.
UNDATED = "undated"
MONTH = "month"
EXPORT = "export_id"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def export_rows(
    rows: DataFrame, target: CommittedTable, date_column: str, record_id: str, writer: str, batch: int
) -> int | None:
    """Append the rows that no earlier export holds, by month, as one version; a batch that was committed adds nothing.

    Records without a date have a partition of their own. A record that the batch holds twice counts once; records without
    an id can't be told apart and all stay. Columns new to the table are added to it, and others widen.
    """
    if target.version().holds(writer, batch):
        return None
    month = F.coalesce(F.date_format(month_floor(date_column), "yyyy-MM"), F.lit(UNDATED))
    dated = rows.withColumn(MONTH, month).persist()
    try:
        # One row for each month of the batch.
        months = [row[MONTH] for row in dated.select(MONTH).distinct().collect()]
        known = F.col(record_id).isNotNull()
        single = dated.where(known).dropDuplicates([MONTH, record_id])
        if months and target.versions():
            stored = target.read(slices=months).select(MONTH, record_id)
            single = single.join(stored, [MONTH, record_id], "left_anti")
        new = single.unionByName(dated.where(~known)).withColumn(EXPORT, F.lit(batch).cast("bigint"))
        return target.append(new, writer, batch)
    finally:
        dated.unpersist()


def export_new_files(
    spark: SparkSession,
    lake_path: str,
    target: CommittedTable,
    checkpoint: str,
    date_column: str,
    record_id: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files: int | None = None,
    glob: str = PARQUET_GLOB,
) -> None:
    """Append the records of a directory's new Parquet files, then stop.

    The stream carries the names of the files alone. Each batch reads them by the schemas in their footers, so columns that later
    files bring, or types that widen, reach the table. A lake file written anew adds only records that are new.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        # The file names of one batch, which the source has listed on the driver.
        paths = [row["path"] for row in batch.select("path").collect()]
        frames = [shape(frame) for frame in frames_by_schema(spark, paths)]
        if frames:
            schema = reduce(merged, [frame.schema for frame in frames])
            rows = reduce(DataFrame.unionAll, [widened(frame, schema) for frame in frames])
            export_rows(rows, target, date_column, record_id, "files", batch_id)

    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", glob)
    reader = reader.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    (
        reader.load(lake_path)
        .select("path")
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def export_new_commits(
    source: CommittedTable,
    target: CommittedTable,
    date_column: str,
    record_id: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> int | None:
    """Append what a table has committed since the last export.

    The target's log holds the last version that was exported, and is written in the same step as the rows. Versions that only
    rewrite files add nothing. The source has to keep its versions until they are exported.
    """
    done, latest = target.version().batches.get("commits", 0), source.version().number
    if latest <= done:
        return None
    return export_rows(shape(source.since(done, latest)), target, date_column, record_id, "commits", latest)
