"""Tables that grow: a log of commits names the files, so that readers see a batch whole or not at all.

A commit writes its files to a folder of its own, describes them in a manifest (path, size, rows, lowest and highest keys),
and is published by renaming one small file to the next version number, which fails if another writer was
first. What a failed commit leaves behind is named by no version. Each version also holds the schema, which widens with
what is appended, and the last batch of every writer, so a repeated batch is left out.

Manifests are tables that Spark writes and reads. On a store without an atomic rename, let one writer commit at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.widen import merged, widened

# Directory of one partition value below a commit's folder; the value itself stays in the files.
SLICE = "_slice"
BIN = "_bin"
TARGET_BYTES = 128 * 1024 * 1024


class CommitConflict(Exception):
    """Other writers were first again and again."""


@dataclass(frozen=True)
class Version:
    """One state of a table."""

    number: int = 0
    # Manifests in effect, as folder names.
    parts: tuple[str, ...] = ()
    # The manifest of the files that this version appended; none where it only rewrote.
    added: str | None = None
    # Schema by the name that manifests give, and the schema of the whole.
    schemas: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    # Last batch of each writer.
    batches: Mapping[str, int] = field(default_factory=dict)

    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema)) if self.schema else T.StructType()

    def holds(self, writer: str, batch: int | None) -> bool:
        return batch is not None and self.batches.get(writer, -1) >= batch


class CommittedTable:
    """A table below a path, its files cut by ``partition`` and ordered by ``cluster_by``.

    The types of these columns are fixed by the first commit; all others may widen.
    """

    def __init__(self, spark: SparkSession, path: str, partition: str, cluster_by: Sequence[str] = ()):
        self.spark, self.path, self.partition, self.cluster_by = spark, path.rstrip("/"), partition, list(cluster_by)
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # The log

    def _hadoop(self, path: str):
        location = self._jvm.org.apache.hadoop.fs.Path(path)
        return location, location.getFileSystem(self._conf)

    def versions(self) -> list[int]:
        """Numbers of the versions that are kept, in order."""
        folder, files = self._hadoop(f"{self.path}/_log")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if re.fullmatch(r"[0-9]{20}\.json", name))

    def version(self, number: int | None = None) -> Version:
        """A version, by default the latest; an empty one if there is none."""
        if number is None:
            known = self.versions()
            if not known:
                return Version()
            number = known[-1]
        location, files = self._hadoop(f"{self.path}/_log/{number:020d}.json")
        stream = files.open(location)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        told = json.loads(text)
        return Version(**told | {"parts": tuple(told["parts"])})

    def _publish(self, change: Callable[[Version], Version | None], attempts: int = 20) -> int | None:
        """Put the change of the latest version in place as the next one; nothing if the change is none."""
        for _ in range(attempts):
            base = self.version()
            new = change(base)
            if new is None:
                return None
            new = replace(new, number=base.number + 1)
            waiting, files = self._hadoop(f"{self.path}/_log/.{uuid.uuid4().hex}")
            stream = files.create(waiting)
            try:
                stream.write(json.dumps(asdict(new)).encode())
            finally:
                stream.close()
            place, _ = self._hadoop(f"{self.path}/_log/{new.number:020d}.json")
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(waiting.toUri(), self._conf)
            kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
            try:
                context.rename(waiting, place, self.spark.sparkContext._gateway.new_array(kinds, 0))
                return new.number
            except Py4JJavaError as error:
                files.delete(waiting, False)
                if "FileAlreadyExists" not in str(error.java_exception):
                    raise
        raise CommitConflict(f"{attempts} attempts to commit to {self.path} met another commit")

    # Writing

    def append(
        self, df: DataFrame, writer: str = "append", batch: int | None = None, by_range: bool = True
    ) -> int | None:
        """Add rows as one version, unless the writer has committed the batch before. Returns the version, if any.

        Rows are dealt by ranges of partition and cluster columns, so each file holds a narrow range of keys; rows of one key are
        told apart by a hash, so a hot key fills several files. With ``by_range`` off, rows are only rebalanced by
        partition, which needs no sample of them and suits small batches.
        """
        return self.prepare(df, writer, batch, by_range)()

    def prepare(
        self, df: DataFrame, writer: str = "append", batch: int | None = None, by_range: bool = True
    ) -> Callable[[], int | None]:
        """Write the rows of an append and return the step that publishes them."""
        before = self.version()
        if before.holds(writer, batch):
            return lambda: None
        keys = [self.partition, *self.cluster_by]
        merged(before.columns(), df.schema, fixed=keys)
        name = uuid.uuid4().hex
        if by_range:
            told_apart = F.xxhash64(*[f.name for f in df.schema.fields if _hashable(f.dataType)])
            laid_out = df.repartitionByRange(*keys, told_apart)
        else:
            laid_out = df.hint("rebalance", F.col(self.partition))
        self._write(laid_out.sortWithinPartitions(*keys), name, [])
        self._describe(name, df.schema)

        def change(base: Version) -> Version | None:
            if base.holds(writer, batch):
                return None
            schema = merged(base.columns(), df.schema, fixed=keys)
            return replace(
                base,
                parts=(*base.parts, name),
                added=name,
                schemas={**base.schemas, _name_of(df.schema): df.schema.json()},
                schema=schema.json(),
                batches={**base.batches, **({writer: batch} if batch is not None else {})},
            )

        return lambda: self._publish(change)

    def _write(self, df: DataFrame, name: str, further: Sequence[str]) -> None:
        sliced = df.withColumn(SLICE, F.col(self.partition).cast("string"))
        sliced.write.partitionBy(SLICE, *further).parquet(f"{self.path}/data/{name}")

    def _describe(self, name: str, schema: T.StructType, also: DataFrame | None = None) -> None:
        """Store the manifest of a commit's folder."""
        files = self._told(name, schema)
        whole = files if also is None else files.unionByName(also)
        whole.write.parquet(f"{self.path}/_files/{name}")

    def _told(self, name: str, schema: T.StructType) -> DataFrame:
        """The manifest of a commit's folder, read back from its files' keys.

        A file has one partition value, which is its own bound. Cluster columns of text are first made distinct by file: bounds
        of texts sort what they aggregate, and that would be every row, beside its path.
        """
        told = self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.path}/data/{name}")
        path, size = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
        by_file = [path, size, F.col(self.partition).alias("slice")]
        texts = [c for c in self.cluster_by if isinstance(schema[c].dataType, T.StringType)]
        others = [c for c in self.cluster_by if c not in texts]
        bounds = [bound(c).alias(f"{word}_{c}") for c in others for word, bound in (("low", F.min), ("high", F.max))]
        files = told.groupBy(*by_file, *texts).agg(F.count(F.lit(1)).alias("rows"), *bounds)
        if texts:
            merged_bounds = [
                bound(f"{word}_{c}" if c in others else c).alias(f"{word}_{c}")
                for c in self.cluster_by
                for word, bound in (("low", F.min), ("high", F.max))
            ]
            files = files.groupBy("path", "bytes", "slice").agg(F.sum("rows").alias("rows"), *merged_bounds)
        return (
            files.withColumn("path", F.regexp_extract("path", "(data/[0-9a-f]{32}/.*)$", 1))
            .withColumns({f"{word}_{self.partition}": F.col("slice") for word in ("low", "high")})
            .withColumn("folder", F.lit(name))
            .withColumn("schema_name", F.lit(_name_of(schema)))
        )

    # Reading

    def files(self, version: Version | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The manifest: path, bytes, slice, rows, low_ and high_ of the keys, folder, schema_name of every live file."""
        version = version or self.version()
        parts = version.parts if parts is None else parts
        held = {f.name: f.dataType for f in version.columns().fields}
        bounds = [
            T.StructField(f"{word}_{c}", held.get(c, T.StringType()))
            for c in (self.partition, *self.cluster_by)
            for word in ("low", "high")
        ]
        schema = T.StructType(
            [
                T.StructField("path", T.StringType()),
                T.StructField("bytes", T.LongType()),
                T.StructField("slice", held.get(self.partition, T.StringType())),
                T.StructField("rows", T.LongType()),
                *bounds,
                T.StructField("folder", T.StringType()),
                T.StructField("schema_name", T.StringType()),
            ]
        )
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/_files/{part}" for part in parts])

    def read(
        self, version: int | None = None, within: Mapping[str, tuple] | None = None, slices: Sequence | None = None
    ) -> DataFrame:
        """The rows of a version, of the latest by default.

        ``within`` gives the least and the greatest value of partition or cluster columns, ``slices`` values of the
        partition column; files that can hold no such row are not listed for the scan.
        """
        state = self.version(version)
        return self._rows(state, self.files(state), within, slices)

    def since(self, version: int, upto: int) -> DataFrame:
        """The rows that the versions after one, up to another, have appended. Rewritten files add none."""
        state = self.version(upto)
        added = [self.version(v).added for v in range(version + 1, upto + 1)]
        return self._rows(state, self.files(state, [part for part in added if part]))

    def _rows(
        self, state: Version, files: DataFrame, within: Mapping[str, tuple] | None = None, slices: Sequence | None = None
    ) -> DataFrame:
        schema = state.columns()
        wanted: list[Column] = []
        if slices is not None:
            files = files.where(F.col("slice").isin(list(slices)))
            wanted.append(F.col(self.partition).isin(list(slices)))
        for c, (low, high) in (within or {}).items():
            files = files.where((F.col(f"high_{c}") >= F.lit(low)) & (F.col(f"low_{c}") <= F.lit(high)))
            wanted.append(F.col(c).between(low, high))
        frames = [
            widened(
                self.spark.read.schema(T.StructType.fromJson(json.loads(state.schemas[name])))
                .option("recursiveFileLookup", True)
                .parquet(*found),
                schema,
            )
            for name, found in self._paths(files)
        ]
        if not frames:
            return self.spark.createDataFrame([], schema)
        rows = reduce(DataFrame.unionAll, frames)
        return rows.where(reduce(lambda a, b: a & b, wanted)) if wanted else rows

    # Upkeep

    def compact(
        self, target_bytes: int = TARGET_BYTES, fold: Callable[[DataFrame], DataFrame] | None = None
    ) -> int | None:
        """Put the small files of each partition value together, up to the target size. Returns the version, if any.

        Files are packed in order of size, smallest first, so that a value whose files are all small ends with as many as its bytes
        fill. Each new file is written by one task, which reads no more than the target and a file. Rows, and what
        ``since`` tells, stay the same. Files appended meanwhile stay as they are. ``fold`` may combine the rows of the files
        that are rewritten; what it leaves of a partition value goes to one file.
        """
        base = self.version()
        if not base.parts:
            return None
        files = self.files(base)
        order = Window.partitionBy("slice").orderBy("bytes", "path")
        ahead = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
        small = files.where(F.col("bytes") < target_bytes).withColumn(
            BIN, F.floor(F.coalesce(ahead, F.lit(0)) / target_bytes)
        )
        crowded = small.groupBy("slice", BIN).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        same = F.col("s.slice").eqNullSafe(F.col("c.slice")) & (F.col(f"s.{BIN}") == F.col(f"c.{BIN}"))
        moved = small.alias("s").join(crowded.alias("c"), same, "left_semi").select("s.*")
        name = uuid.uuid4().hex
        # Stored, so that the plan of a large table is made once.
        moved.write.parquet(f"{self.path}/_plans/{name}")
        moved = self.spark.read.schema(moved.schema).parquet(f"{self.path}/_plans/{name}")
        if moved.isEmpty():
            return None
        schema = base.columns()
        rows = self._rows_by_path(base, moved)
        bins = moved.select(F.col("path").alias("_path"), BIN)
        tasks = max(1, min(moved.select("slice", BIN).distinct().count(), 100_000))
        dealt = rows.join(bins, "_path").drop("_path")
        if fold:
            dealt = fold(dealt.drop(BIN)).withColumn(BIN, F.lit(0))
        dealt = dealt.repartition(tasks, self.partition, BIN)
        self._write(dealt.sortWithinPartitions(self.partition, BIN, *self.cluster_by), name, [BIN])
        others = files.join(moved.select("path"), "path", "left_anti")
        self._describe(name, schema, others)

        def change(now: Version) -> Version | None:
            if now.parts[: len(base.parts)] != base.parts:
                return None  # another run has rewritten the same files
            schemas = {**now.schemas, _name_of(schema): schema.json()}
            return replace(now, parts=(name, *now.parts[len(base.parts) :]), added=None, schemas=schemas)

        return self._publish(change)

    def _rows_by_path(self, state: Version, files: DataFrame) -> DataFrame:
        """Rows of the files with the path that the manifest has for them."""
        wanted = state.columns().add("_path", "string")
        told = F.regexp_extract(F.col("_metadata.file_path"), "(data/[0-9a-f]{32}/.*)$", 1)
        frames = []
        for name, found in self._paths(files):
            own = T.StructType.fromJson(json.loads(state.schemas[name]))
            read = self.spark.read.schema(own).option("recursiveFileLookup", True).parquet(*found)
            frames.append(widened(read.withColumn("_path", told), wanted))
        return reduce(DataFrame.unionAll, frames)

    def _paths(self, files: DataFrame) -> list[tuple[str, list[str]]]:
        """Paths by schema name: one for each file of the scan, which Spark would list on the driver as well."""
        paths: dict[str, list[str]] = {}
        for row in files.select("schema_name", "path").collect():
            paths.setdefault(row["schema_name"], []).append(f"{self.path}/{unquote(row['path'])}")
        return [(name, sorted(found)) for name, found in sorted(paths.items())]

    def vacuum(self, keep: int = 1) -> list[str]:
        """Forget all but the latest versions, and delete the folders that those name no file of. Returns their names.

        Run it while no commit is under way: what a commit has written but not published is named by no version.
        """
        known = self.versions()
        kept = [self.version(v) for v in known[-keep:]]
        live = {row["folder"] for state in kept for row in self.files(state).select("folder").distinct().collect()}
        parts = {part for state in kept for part in state.parts}
        gone = []
        for place, used in (("data", live), ("_files", parts), ("_plans", set())):
            folder, files = self._hadoop(f"{self.path}/{place}")
            for status in files.listStatus(folder) if files.exists(folder) else []:
                if status.getPath().getName() not in used:
                    files.delete(status.getPath(), True)
                    gone.append(f"{place}/{status.getPath().getName()}")
        for number in known[:-keep]:
            location, files = self._hadoop(f"{self.path}/_log/{number:020d}.json")
            files.delete(location, False)
        return sorted(gone)


def _name_of(schema: T.StructType) -> str:
    return uuid.uuid5(uuid.NAMESPACE_OID, schema.json()).hex


def _hashable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.AtomicType, T.NullType))
