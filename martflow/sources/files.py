"""File sources."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.conform import align, cast_present, fill_nulls, present, rescue, union_all

PARQUET_GLOB = "*.parquet"


def read_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Parquet files of a directory, a list of paths or a glob pattern."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_partitioned(spark: SparkSession, root: str, within: Sequence[str] = ()) -> DataFrame:
    """Hive-partitioned Parquet. Partition columns are found from directory names and prune the scan.

    ``within`` names partition directories below the root to read only those.
    """
    paths = [f"{root}/{part}" for part in within] or [root]
    return spark.read.option("basePath", root).parquet(*paths)


FOOTER = "path string, length long, modified timestamp, signature string, spark_schema string"


def _footers(files: DataFrame) -> DataFrame:
    """Footer schemas of files (path, length, modified), opened on the executors."""

    # Defined here, so that it travels inside the tasks and executors need no copy of the library.
    def opened(batches):
        import re
        from urllib.parse import quote

        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        from pyspark.errors import PySparkTypeError
        from pyspark.sql.pandas.types import from_arrow_schema
        from pyspark.sql.types import StructType

        for batch in batches:
            signatures, schemas = [], []
            for path in batch["path"]:
                uri = quote(re.sub("^file:/+", "file:///", path), safe=":/=+,@!$&'()*;~")
                filesystem, local = pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))
                schema = pq.read_schema(local, filesystem=filesystem)
                signatures.append("|".join(sorted(f"{name}:{kind}" for name, kind in zip(schema.names, schema.types))))
                try:
                    fields = from_arrow_schema(schema).fields
                    schemas.append(StructType(sorted(fields, key=lambda f: f.name)).json())
                except PySparkTypeError:
                    schemas.append(None)  # left to Spark
            yield batch.assign(signature=signatures, spark_schema=schemas)

    return files.mapInPandas(opened, FOOTER)


def _listed(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """path, length, modified of the files below a path. The listing is made by tasks, and no file is opened."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return listing.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def footer_schemas(spark: SparkSession, path: str, glob: str = PARQUET_GLOB, index: str | None = None) -> DataFrame:
    """path, length, modified, signature, spark_schema of every file below a path.

    With an ``index``, a folder of what earlier scans have found, only files that are new or have changed
    are opened, and are added to it.
    """
    listing = _listed(spark, path, glob)
    if index is None:
        return _footers(listing)
    known = read_or_default(
        lambda: spark.read.schema(FOOTER).parquet(index), lambda: spark.createDataFrame([], FOOTER)
    )
    new = _footers(listing.join(known, ["path", "length", "modified"], "left_anti"))
    new.write.mode("append").parquet(index)
    stored = spark.read.schema(FOOTER).parquet(index).dropDuplicates(["path", "length", "modified"])
    return listing.join(stored, ["path", "length", "modified"])


@dataclass(frozen=True)
class SchemaGroup:
    """Files, or directories all of whose files count, of one physical schema; the schema, if it is known without Spark."""

    paths: list[str]
    schema: T.StructType | None


def schema_groups(
    spark: SparkSession, path: str, glob: str = PARQUET_GLOB, index: str | None = None
) -> dict[str, SchemaGroup]:
    """What lies below a path, by the physical schema in the footers.

    Footers are read in parallel on the executors. A directory whose files have one schema reaches the driver as one row;
    only the files of mixed directories are named one by one.
    """
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")
    told = footer_schemas(spark, path, glob, index).select("path", folder, "signature", "spark_schema").persist()
    try:
        kinds = F.collect_set(F.struct("signature", "spark_schema")).alias("kinds")
        folders = told.groupBy("folder").agg(kinds).collect()
        if not folders:
            raise FileNotFoundError(f"no files that match {glob} below {path}")
        # A directory with others below it would bring theirs along.
        above = {"/".join(r["folder"].split("/")[:k]) for r in folders for k in range(r["folder"].count("/") + 1)}
        whole = [r for r in folders if len(r["kinds"]) == 1 and r["folder"] not in above]
        found = [(r["kinds"][0]["signature"], r["kinds"][0]["spark_schema"], r["folder"]) for r in whole]
        if len(whole) < len(folders):
            names = spark.createDataFrame([(r["folder"],) for r in whole], "folder string")
            mixed = told.join(names, "folder", "left_anti").select("signature", "spark_schema", "path")
            found += [tuple(row) for row in mixed.toLocalIterator()]
    finally:
        told.unpersist()
    groups: dict[str, SchemaGroup] = {}
    for signature, schema, place in sorted(found, key=lambda row: (row[0], row[2])):
        declared = T.StructType.fromJson(json.loads(schema)) if schema else None
        groups.setdefault(signature, SchemaGroup([], declared)).paths.append(place)
    return groups


def _read_group(spark: SparkSession, group: SchemaGroup, base: str, glob: str) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", glob)
    if group.schema is not None:
        reader = reader.schema(group.schema)
    if all("=" in place[len(base) :] or "=" in place.rsplit("/", 1)[-1] for place in group.paths):
        # Partition columns come from the names of the directories below the path.
        reader = reader.option("basePath", base)
    return reader.parquet(*group.paths)


def frames_by_schema(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The rows of some files, one frame for each physical schema."""
    if not paths:
        return []
    tasks = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    named = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    files = named.select("path", F.lit(0).cast("long").alias("length"), F.lit(None).cast("timestamp").alias("modified"))
    groups: dict[str, SchemaGroup] = {}
    for row in _footers(files).toLocalIterator():
        declared = T.StructType.fromJson(json.loads(row["spark_schema"])) if row["spark_schema"] else None
        groups.setdefault(row["signature"], SchemaGroup([], declared)).paths.append(row["path"])
    return [_read_group(spark, group, "", "*") for _, group in sorted(groups.items())]


def read_drifting(
    spark: SparkSession,
    path: str,
    drifting: Iterable[str] = (),
    schema: T.StructType | None = None,
    cast_to: str = "double",
    fill: float | None = 0,
    glob: str = PARQUET_GLOB,
    index: str | None = None,
    rescued: str | None = None,
) -> DataFrame:
    """Parquet files whose columns come and go, or change between integer and floating point.

    Files are read in one scan per distinct schema, so the plan grows with the number of schemas, not of files.
    Drifting columns are cast, texts that hold no number and missing columns become null, and the drifting columns' nulls are
    filled. With a ``schema`` the result is cast to it instead of being the union of what the files hold. ``index`` names a
    folder that keeps the schemas of known files. ``rescued`` names a column for a map of the drifting values that the cast could
    not hold; such a value is null and is not filled.
    """
    drifting = list(drifting)
    frames = []
    for group in schema_groups(spark, path, glob, index).values():
        frame = _read_group(spark, group, path, glob)
        if rescued:
            frame = rescue(frame, drifting, cast_to, rescued)
        frames.append(align(frame, schema) if schema is not None else cast_present(frame, drifting, cast_to))
    whole = union_all(frames)
    if fill is None:
        return whole
    if rescued is None:
        return fill_nulls(whole, drifting, fill)
    held = present(whole, drifting)
    lost = {c: F.coalesce(F.map_contains_key(F.col(rescued), F.lit(c)), F.lit(False)) for c in held}
    return whole.withColumns({c: F.when(~lost[c], F.coalesce(c, F.lit(fill).cast(cast_to))) for c in held})


def read_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small in-memory table with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV with a header. A header that differs from the schema, or a bad value, fails the read."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Data dictionary: field and description, trimmed, without the leading colon."""
    raw = spark.read.csv(path, header=True, quote='"', schema="FIELDS string, DESCRIPTION string")
    description = F.trim(F.ltrim(F.trim("DESCRIPTION"), F.lit(":")))
    return raw.select(F.trim("FIELDS").alias("field"), description.alias("description"))


def dictionary_values(dictionary: DataFrame) -> DataFrame:
    """Accepted values listed in a dictionary (``Kind of x: A, B, C``), one row per field and value."""
    listed = F.regexp_extract("description", r":\s*(.+,.+)$", 1)
    return (
        dictionary.withColumn("listed", listed)
        .where("listed <> ''")
        .select("field", F.explode(F.split("listed", r"\s*,\s*")).alias("accepted"))
    )


def read_messy_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with carriage returns, blank lines or an unfinished last line; one record per line.

    Quotes inside quoted values are doubled, as usual in CSV. The header is recognised by its text. A value that is not
    of its column's type fails the read.
    """
    header = ",".join(f.name for f in schema.fields)
    line = F.regexp_replace("value", "\r", "")
    lines = spark.read.text(path, lineSep="\n").select(line.alias("line"))
    records = lines.where((F.trim("line") != "") & (F.trim("line") != header))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("line", ddl, {"quote": '"', "escape": '"', "mode": "FAILFAST"})
    return records.select(parsed.alias("r")).select("r.*")


def _missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def read_or_default(read: Callable[[], DataFrame], default: Callable[[], DataFrame]) -> DataFrame:
    """A source, or a default where its path does not exist. Every other error is raised."""
    try:
        return read()
    except AnalysisException as error:
        if _missing(error):
            return default()
        raise


def data_present(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, bool]:
    """For each named path, whether Parquet rows can be read from it."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = not spark.read.option("pathGlobFilter", PARQUET_GLOB).parquet(path).isEmpty()
        except AnalysisException as error:
            if not _missing(error) and error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            found[name] = False
    return found
