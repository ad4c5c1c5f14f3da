"""Schemas that widen: a type that holds the values of two, and casts that lose none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal digits that integers of each kind can have.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
INTEGERS = tuple(DIGITS)
# Integers below this are doubles without a loss.
EXACT_IN_DOUBLE = 2**53


class SchemaConflict(Exception):
    """A column whose type must stay would change."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text if there is no other.

    Integers go to the larger, with decimals to a decimal of all places, with floating point to double. Dates go to
    times. Structs, arrays and maps widen inside.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, INTEGERS) and isinstance(b, INTEGERS):
        return max(a, b, key=lambda kind: DIGITS[type(kind)])
    exact = (T.DecimalType, *INTEGERS)
    if isinstance(a, exact) and isinstance(b, exact):
        places = max(getattr(a, "scale", 0), getattr(b, "scale", 0))
        whole = max(_whole_digits(a), _whole_digits(b))
        return T.DecimalType(whole + places, places) if whole + places <= 38 else T.StringType()
    numbers = (T.FloatType, T.DoubleType, *INTEGERS)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return T.DoubleType()
    times = (T.DateType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType), wider(a.valueType, b.valueType), True)
    return T.StringType()


def _whole_digits(kind: T.DataType) -> int:
    return kind.precision - kind.scale if isinstance(kind, T.DecimalType) else DIGITS[type(kind)]


def merged(a: T.StructType, b: T.StructType, fixed: Sequence[str] = ()) -> T.StructType:
    """The columns of both, widened and nullable; those of the first in their order, then the others.

    Columns named ``fixed`` must have the same type in both, if both have them.
    """
    given = {f.name: f.dataType for f in b.fields}
    for f in a.fields:
        if f.name in fixed and f.name in given and given[f.name] != f.dataType:
            raise SchemaConflict(f"{f.name} is {f.dataType.simpleString()} and can't become {given[f.name].simpleString()}")
    known = {f.name for f in a.fields}
    both = [T.StructField(f.name, wider(f.dataType, given.get(f.name, f.dataType)), True) for f in a.fields]
    return T.StructType(both + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name not in known])


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a schema that is as wide in every column; absent columns become null, others are left out.

    A whole number that a double can't hold fails the job.
    """
    given = {f.name: f.dataType for f in df.schema.fields}

    def cast(f: T.StructField) -> Column:
        if f.name not in given:
            return F.lit(None).cast(f.dataType).alias(f.name)
        value = F.col(f.name)
        if isinstance(given[f.name], T.LongType) and isinstance(f.dataType, T.DoubleType):
            told = F.concat(F.lit(f"{f.name} is a double column and can't hold "), value.cast("string"))
            fits = value.isNull() | value.between(-EXACT_IN_DOUBLE, EXACT_IN_DOUBLE)
            return F.when(fits, value.cast("double")).otherwise(F.raise_error(told).cast("double")).alias(f.name)
        if isinstance(f.dataType, T.StringType) and isinstance(given[f.name], (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(value).alias(f.name)
        return (value if given[f.name] == f.dataType else value.cast(f.dataType)).alias(f.name)

    return df.select(*[cast(f) for f in schema.fields])
