"""Micro-batch ingest: message texts to a lake of typed records, each kept once, misfits set aside.

Records go to a table whose log names the files of each batch, so a batch is stored whole or not at all, and one
repeated after a failure is left out. Offsets are committed by the checkpoint only after that. A second table holds, for
each event day, bitmaps of the hashed ids that are stored: a batch reads stored ids only where its own ids meet a set bit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martflow.operators.conform import is_sound, parse_json
from martflow.sinks.committed import TARGET_BYTES, CommittedTable
from martflow.sinks.files import write_partitioned
from martflow.sources.messages import Landing, Topic, read_messages

BATCH = "batch_id"
DAY = "event_date"
MESSAGE = "_message"
# Ids are hashed to numbers below this; each bucket of 32768 numbers has one bitmap a day, so a day takes 1 MB at most. Of a
# day with a million ids one in eight new ids meets a set bit, and its bucket is read; with many more ids than that
# the bits are full, and the day's ids are read. Must stay the same for a lake.
ID_SPACE = 1 << 23
BUCKET, POSITION, MONTH = "_bucket", "_position", "_month"
WRITER = "ingest"


@dataclass(frozen=True)
class Lake:
    """Where an ingest keeps its records, its rejected messages and its progress."""

    root: str

    @property
    def records(self) -> str:
        return f"{self.root}/records"

    @property
    def seen(self) -> str:
        return f"{self.root}/seen"

    def records_table(self, spark: SparkSession) -> CommittedTable:
        return CommittedTable(spark, self.records, DAY, [BUCKET])

    def seen_table(self, spark: SparkSession) -> CommittedTable:
        # A file for the month, not for each of the days that a batch has.
        return CommittedTable(spark, self.seen, MONTH, [DAY, BUCKET])

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


@dataclass(frozen=True)
class MessageFormat:
    """Declared message schema, its id, its event time and the columns no record may lack."""

    schema: T.StructType
    message_id: str = "message_id"
    event_time: str = "timestamp"

    @property
    def required(self) -> list[str]:
        return [self.message_id, self.event_time]


def read_if_any(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A directory's rows, or none while nothing has been written to it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return spark.createDataFrame([], schema)
        raise


def hashed(message_id: str) -> tuple[Column, Column]:
    """Bucket and bit of an id."""
    number = F.pmod(F.xxhash64(message_id), F.lit(ID_SPACE))
    return F.bitmap_bucket_number(number).alias(BUCKET), F.bitmap_bit_position(number).alias(POSITION)


def maybe_stored(fresh: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of a batch whose bit a stored bitmap has: all that are stored, and few others."""
    byte = F.expr(f"substring(bits, cast({POSITION} div 8 as int) + 1, 1)")
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col(POSITION) % 8).cast("int"))
    return fresh.join(seen.select(DAY, BUCKET, "bits"), [DAY, BUCKET]).where(bit != 0)


def stored_ids(table: CommittedTable, message_id: str, days: Sequence, buckets: Sequence[int]) -> DataFrame:
    """Day and id of the stored records of some days that lie in some buckets."""
    rows = table.read(slices=days, within={BUCKET: (min(buckets), max(buckets))})
    return rows.where(F.col(BUCKET).isin(list(buckets))).select(DAY, message_id)


def not_yet_stored(fresh: DataFrame, lake: Lake, message_id: str, days: Sequence) -> DataFrame:
    """Records whose id is not stored for their day.

    A redelivered message carries the same event time. Bitmaps of the batch's own days tell which ids may be
    stored; only where there are such ids are stored ones read, by day and bucket, and compared.
    """
    spark = fresh.sparkSession
    bits = lake.seen_table(spark)
    found = []
    if bits.versions():
        seen = bits.read(slices=sorted({f"{day:%Y-%m}" for day in days})).where(F.col(DAY).isin(list(days)))
        # A row for each day and bucket: there are 256 buckets.
        found = maybe_stored(fresh, seen).select(DAY, BUCKET).distinct().collect()
    table = lake.records_table(spark)
    # A batch that was lost before its records were committed has left bits alone.
    if not found or not table.versions():
        return fresh
    stored = stored_ids(table, message_id, sorted({r[DAY] for r in found}), sorted({r[BUCKET] for r in found}))
    return fresh.join(stored, [DAY, message_id], "left_anti")


def store_batch(lake: Lake, form: MessageFormat) -> Callable[[DataFrame, int], None]:
    """The step that stores one batch of message texts."""

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        records_table, seen_table = lake.records_table(spark), lake.seen_table(spark)
        dated = parse_json(batch, form.schema, keep=MESSAGE).withColumn(DAY, F.to_date(form.event_time))
        parsed = dated.select("*", *hashed(form.message_id)).persist()
        stamp = F.lit(batch_id).cast("bigint").alias(BATCH)
        sound = is_sound(form.required)
        try:
            # One row for each day of the batch.
            counted = parsed.groupBy(F.when(sound, F.col(DAY)).alias("day")).agg(F.count_if(~sound).alias("n")).collect()
            days = [row["day"] for row in counted if row["day"] is not None]
            misfits = sum(row["n"] for row in counted)
            if days and not records_table.version().holds(WRITER, batch_id):
                records = parsed.where(sound).drop(MESSAGE, "_corrupt").dropDuplicates([DAY, form.message_id])
                records = not_yet_stored(records, lake, form.message_id, days)
                bits = parsed.where(sound).groupBy(DAY, BUCKET).agg(F.bitmap_construct_agg(POSITION).alias("bits"))
                bits = bits.withColumn(MONTH, F.date_format(DAY, "yyyy-MM"))
                with ThreadPoolExecutor(max_workers=2) as pool:
                    steps = [
                        pool.submit(table.prepare, rows, WRITER, batch_id, False)
                        for table, rows in ((seen_table, bits), (records_table, records.drop(POSITION).select("*", stamp)))
                    ]
                # Bits first: a bit without a record costs a look, a record without a bit would be stored twice.
                for step in steps:
                    step.result()()
            if misfits:
                rejected = parsed.where(~sound).select(MESSAGE, stamp)
                write_partitioned(rejected, lake.quarantine, [BATCH])
        finally:
            parsed.unpersist()

    return store


def compact_lake(spark: SparkSession, lake: Lake, target_bytes: int = TARGET_BYTES) -> None:
    """Put the small files that batches have left together, day by day, and the bitmaps of each month into one file."""

    def folded(bits: DataFrame) -> DataFrame:
        return bits.groupBy(MONTH, DAY, BUCKET).agg(F.bitmap_or_agg("bits").alias("bits"))

    # Most of either is the driver's work on manifests, so they run side by side.
    with ThreadPoolExecutor(max_workers=2) as pool:
        steps = [
            pool.submit(lake.records_table(spark).compact, target_bytes),
            pool.submit(lake.seen_table(spark).compact, target_bytes, folded),
        ]
    for step in steps:
        step.result()


def ingest(
    spark: SparkSession,
    where: Topic | Landing,
    lake: Lake,
    form: MessageFormat,
    every: str | None = None,
) -> StreamingQuery:
    """Start an ingest.

    With ``every`` it runs on and flushes at that interval. Otherwise it drains what is there, last partial batch
    included, and stops; run again on the same lake it goes on where it stopped.
    """
    writer = (
        read_messages(spark, where)
        .writeStream.foreachBatch(store_batch(lake, form))
        .option("checkpointLocation", lake.checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def drain(spark: SparkSession, where: Topic | Landing, lake: Lake, form: MessageFormat) -> None:
    """One scheduled run: take in everything that has arrived since the last."""
    ingest(spark, where, lake, form).awaitTermination()


def stored_records(spark: SparkSession, lake: Lake, form: MessageFormat) -> DataFrame:
    table = lake.records_table(spark)
    if table.versions():
        return table.read().drop(BUCKET)
    partitions = [T.StructField(DAY, T.DateType()), T.StructField(BATCH, T.LongType())]
    return spark.createDataFrame([], T.StructType([*form.schema.fields, *partitions]))


def quarantined(spark: SparkSession, lake: Lake) -> DataFrame:
    schema = T.StructType([T.StructField(MESSAGE, T.StringType()), T.StructField(BATCH, T.LongType())])
    return read_if_any(spark, lake.quarantine, schema)


def drop_redelivered(stream: DataFrame, message_id: str, event_time: str, horizon: str) -> DataFrame:
    """Duplicate removal inside the stream, with state bounded by an event-time horizon.

    Records later than the horizon are dropped by the watermark; ``ingest`` has no such limit.
    """
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([message_id])


def plain_file_sink(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()):
    """Exactly-once Parquet file sink for a stream that needs no further treatment."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start()
