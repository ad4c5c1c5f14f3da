"""Bring records into a declared shape."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions import scalar
from martflow.operators.widen import wider


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The named columns that the frame has."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def parse_dates(df: DataFrame, columns: Iterable[str], pattern: str = "yyyy-MM-dd") -> DataFrame:
    """Turn date texts into dates; texts that do not parse become null."""
    return df.withColumns({c: scalar.parse_date(c, pattern) for c in present(df, columns)})


def cast_present(df: DataFrame, columns: Iterable[str], to: str = "double") -> DataFrame:
    """Cast columns; values that can't be cast become null."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in present(df, columns)})


def rescue(df: DataFrame, columns: Iterable[str], to: str = "double", name: str = "_rescued") -> DataFrame:
    """Cast columns and keep what the cast can't hold, as text by column, in a map; null where there is none.

    A value is held if casting it back gives the same value, so a number that would be rounded is kept as well.
    """

    def held(c: str) -> Column:
        kind = df.schema[c].dataType
        cast = F.col(c).try_cast(to)
        if isinstance(kind, T.StringType):
            return cast.isNotNull()
        return cast.try_cast(kind).eqNullSafe(F.col(c))

    named = present(df, columns)
    lost = [
        F.when(F.col(c).isNotNull() & ~held(c), F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")))
        for c in named
    ]
    kept = F.map_from_entries(F.array_compact(F.array(*lost))) if lost else F.lit(None).cast("map<string,string>")
    values = {c: F.when(held(c), F.col(c).try_cast(to)) for c in named}
    return df.withColumns({**values, name: F.when(F.size(kept) > 0, kept) if lost else kept})


def fill_nulls(df: DataFrame, columns: Iterable[str], value: float = 0) -> DataFrame:
    return df.na.fill(value, present(df, columns))


def add_date_parts(df: DataFrame, source: str = "timestamp") -> DataFrame:
    """Add ``date``, ``year``, ``month`` and ``day`` of a timestamp; frames without it pass unchanged."""
    if source not in df.columns:
        return df
    if isinstance(df.schema[source].dataType, T.StringType):
        day = scalar.iso_date(source)
    else:
        day = F.to_date(F.col(source))
    return df.withColumns({"date": day, "year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def pick(df: DataFrame, names: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Project to a contract: a list of columns, or a mapping source name -> contract name."""
    if isinstance(names, Mapping):
        return df.select(*[F.col(source).alias(target) for source, target in names.items()])
    return df.select(*names)


def with_constants(df: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def audited(df: DataFrame, as_of: datetime | date | Column, name: str = "loaded_at") -> DataFrame:
    """Add the audit time. The caller states it, so reloading gives the same rows."""
    return df.withColumn(name, as_of if isinstance(as_of, Column) else F.lit(as_of))


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a declared schema by name; absent columns become null, undeclared ones are left out.

    A number or time that the column can't hold as it is fails the job: nothing is rounded or cut.
    """
    given = {f.name: f.dataType for f in df.schema.fields}

    def conformed(f: T.StructField) -> Column:
        if f.name not in given:
            return F.lit(None).cast(f.dataType)
        value, kind = F.col(f.name), given[f.name]
        cast = value.cast(f.dataType)
        if not may_lose(kind, f.dataType):
            return cast
        word = "an integer" if isinstance(f.dataType, T.IntegralType) else f"a {f.dataType.simpleString()}"
        told = F.concat(F.lit(f"{f.name} is {word} column and can't hold "), value.cast("string"))
        back = value.try_cast(f.dataType).try_cast(kind)
        return F.when(value.isNull() | back.eqNullSafe(value), cast).otherwise(F.raise_error(told).cast(f.dataType))

    return df.select(*[conformed(f).alias(f.name) for f in schema.fields])


def may_lose(given: T.DataType, to: T.DataType) -> bool:
    """Whether a cast can give another value without failing: numbers cut or rounded, times cut to days."""
    numbers = (T.NumericType, T.DecimalType)
    if isinstance(given, numbers) and isinstance(to, numbers):
        return wider(given, to) != to or isinstance(given, T.LongType) and isinstance(to, T.DoubleType)
    return isinstance(given, (T.TimestampType, T.TimestampNTZType)) and isinstance(to, T.DateType)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing from a frame become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def latest_by_key(df: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """One row per key: the latest by event time. A plain aggregate, so a hot key is combined map-side."""
    others = [c for c in df.columns if c not in keys]
    newest = F.max(F.struct(F.col(event_time).alias("_at"), F.struct(*others).alias("_row"))).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest._row.*").select(*df.columns)


def parse_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    corrupt: str = "_corrupt",
    keep: str | None = None,
) -> DataFrame:
    """Parse a JSON text into declared columns.

    Unknown keys are dropped and missing ones are null. A text that is no JSON object, or holds a value of
    the wrong type, is put whole in the ``corrupt`` column. ``keep`` names a column for the text itself.
    """
    declared = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    with_corrupt = T.StructType([*declared.fields, T.StructField(corrupt, T.StringType(), True)])
    parsed = F.from_json(
        F.col(value), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    )
    others = [c for c in df.columns if c != value]
    texts = [F.col(value).alias(keep)] if keep else []
    return df.select(*others, *texts, parsed.alias("_json")).select(*others, *([keep] if keep else []), "_json.*")


def is_sound(required: Sequence[str], corrupt: str = "_corrupt") -> Column:
    """Whether a parsed record is well-formed and holds every required column."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required], F.col(corrupt).isNull())


def split_valid(
    parsed: DataFrame, required: Sequence[str], corrupt: str = "_corrupt"
) -> tuple[DataFrame, DataFrame]:
    """The sound records, and the rest."""
    sound = is_sound(required, corrupt)
    return parsed.where(sound), parsed.where(~sound)


def infer_json_schema(spark: SparkSession, sample: str) -> T.StructType:
    """Schema of one sample record, for drafting a declared schema; not meant for the ingest path.

    Numbers become bigint or double, and booleans stay boolean.
    """
    parsed = spark.range(1).select(F.from_json(F.lit(sample), F.schema_of_json(F.lit(sample))).alias("r"))
    return parsed.schema["r"].dataType


def infer_json_schema_of_all(df: DataFrame, value: str = "value") -> T.StructType:
    """Schema of all JSON objects of a column: every key that any text has, with a type that holds all its values.

    One aggregation over all rows, combined map-side; its single result reaches the driver. Whole numbers become
    bigint, or a decimal if they have more digits, others double; dates and times stay text. Values of kinds that no type holds, and keys that are always null,
    become text. Texts that are no JSON object are left out.
    """
    parsed = F.try_parse_json(value)
    objects = df.select(parsed.alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    told = objects.agg(F.schema_of_variant_agg("v")).first()[0]
    if not told or not told.startswith("OBJECT"):
        return T.StructType()
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", told)
    return _as_json_types(T._parse_datatype_string(ddl))


def _as_json_types(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_json_types(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_json_types(kind.elementType), True)
    if isinstance(kind, T.DecimalType):
        if kind.scale:
            return T.DoubleType()
        return T.LongType() if kind.precision <= 18 else kind
    if isinstance(kind, (T.DoubleType, T.FloatType, T.LongType, T.BooleanType)):
        return kind
    return T.StringType()
