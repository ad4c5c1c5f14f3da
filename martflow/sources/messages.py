"""Message streams: a Kafka topic, or a landing directory of JSON lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Topic:
    """A Kafka topic, read from its first offset until a checkpoint says otherwise.

    Small batches wait for ``min_records`` or ``max_delay``, whichever comes first. Needs the Kafka connector
    on the classpath.
    """

    servers: str
    name: str
    starting: str = "earliest"
    max_records: int | None = None
    min_records: int | None = 50
    max_delay: str = "10s"

    def options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": self.starting,
            "failOnDataLoss": "true",
        }
        if self.max_records:
            options["maxOffsetsPerTrigger"] = str(self.max_records)
        if self.min_records:
            options["minOffsetsPerTrigger"] = str(self.min_records)
            options["maxTriggerDelay"] = self.max_delay
        return options


@dataclass(frozen=True)
class Landing:
    """A directory that receives files with one JSON message per line."""

    path: str
    max_files: int | None = None

    def options(self) -> dict[str, str]:
        return {"maxFilesPerTrigger": str(self.max_files)} if self.max_files else {}


def read_messages(spark: SparkSession, where: Topic | Landing) -> DataFrame:
    """The stream of message texts, in a column ``value``."""
    if isinstance(where, Topic):
        raw = spark.readStream.format("kafka").options(**where.options()).load()
        return raw.select(F.col("value").cast("string").alias("value"))
    return spark.readStream.format("text").options(**where.options()).load(where.path).select("value")
