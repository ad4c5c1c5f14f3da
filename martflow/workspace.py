"""Intermediate results in the folder shared by all executors.

Cutting lineage means writing a Parquet table below ``spark.checkpoint.dir`` and reading it back, so that a
lost executor never takes an intermediate result with it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_folder: ContextVar[str | None] = ContextVar("martflow_run_folder", default=None)


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session that names none gets a folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="martflow-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path nothing has been written to yet."""
    return f"{_folder.get() or shared_root(spark) + '/martflow'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all that is stored within the block; it goes when the block ends.

    What depends on it must be written or collected within the block. Blocks may be nested; each removes its own folder.
    """
    path = new_path(spark, "run")
    token = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(token)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(
    df: DataFrame, label: str = "cut", by: str | None = None, sort_by: Sequence[str] = ()
) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it: stable rows, short lineage.

    With ``by`` the rows are stored in buckets of this column, one for each shuffle partition, and sorted in each bucket.
    Groupings, windows and joins by it (and further columns) read a bucket in one task and shuffle nothing, so it should
    have no hot value.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = df.repartition(by).write.option("compression", "zstd").bucketBy(buckets, by).sortBy(*(sort_by or [by]))
    # Only the catalog knows of buckets. The scan keeps them when the entry goes, and so do the files, as they have a path.
    table = f"martflow_{uuid.uuid4().hex}"
    try:
        stored.saveAsTable(table, format="parquet", path=path)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
