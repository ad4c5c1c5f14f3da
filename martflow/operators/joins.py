"""Joins around a base table.

A dimension that ``sent_whole`` has measured to be small goes whole to every executor, so that the base is not shuffled
for it. Otherwise no join hints: adaptive execution splits hot keys of the sort-merge joins that remain.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions.scalar import ColumnLike, as_id, col

MATCH_CHUNK = 100_000
# What a dimension may hold to be sent whole; a few times that in an executor's memory.
WHOLE_BYTES = 64 * 1024 * 1024
# A key is hot if it has this many times the rows of an even task, and so many rows at least.
HOT_TIMES, HOT_ROWS = 4, 100_000
HASHES_PER_TASK = 16


def sent_whole(dimension: DataFrame, most_bytes: int = WHOLE_BYTES) -> DataFrame:
    """The dimension with a broadcast hint, if its rows measure no more than so many bytes; else as it is.

    One pass over the dimension measures it: a plan's estimate of an aggregate or a join is far too high.
    """

    def width(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
        return F.lit(8 if isinstance(f.dataType, T.AtomicType) else most_bytes)

    widths = reduce(lambda a, b: a + b, [width(f).cast("bigint") for f in dimension.schema.fields])
    measured = dimension.agg(F.sum(widths + 8)).first()[0] or 0
    return F.broadcast(dimension) if measured <= most_bytes else dimension


def is_even(df: DataFrame, key: ColumnLike) -> bool:
    """Whether no key is so hot that a shuffle by it would put far more rows into one task than into others.

    One pass over the key; counts of hashed keys tell, so that little is shuffled for them.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = F.pmod(F.xxhash64(col(key)), F.lit(HASHES_PER_TASK * tasks))
    most, rows = df.groupBy(hashed.alias("h")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first()
    return most is not None and (most <= HOT_ROWS or most * tasks <= rows * HOT_TIMES)


def dealt_once(df: DataFrame, key: str, even: bool | None = None) -> DataFrame:
    """Rows shuffled by one key, which serves all groupings, windows and joins by it (and further columns) that follow.

    If the key is not even, the rows stay as they are, and each later step shuffles on its own, combined map-side or
    split. ``even`` tells what is known.
    """
    return df.repartition(key) if (is_even(df, key) if even is None else even) else df


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reduce a dimension to one row per key, the smallest by its remaining columns."""
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    smallest = F.min(F.struct(*others)).alias("_row")
    return df.groupBy(*keys).agg(smallest).select(*keys, "_row.*").select(*df.columns)


def star(base: DataFrame, dimensions: Sequence[tuple[DataFrame, Sequence[str]]], how: str = "left") -> DataFrame:
    """Join a chain of dimensions to a base, each on its own key columns."""
    for dimension, keys in dimensions:
        base = base.join(dimension, list(keys), how)
    return base


def combined(dimensions: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Dimensions with the same key in one table, so that a large base is shuffled and joined once for all."""
    whole = dimensions[0]
    for dimension in dimensions[1:]:
        whole = whole.join(dimension, list(keys), "full")
    return whole


def join_cast_key(
    base: DataFrame, dimension: DataFrame, base_key: str, dimension_key: str, how: str = "left"
) -> DataFrame:
    """Join a text key to an integer key; texts that hold no integer match nothing."""
    matched = dimension.withColumnRenamed(dimension_key, "_dim_key")
    return base.join(matched, as_id(base_key) == F.col("_dim_key"), how).drop("_dim_key")


MATCHES = "_matches"


def count_matches(base: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the number of rows each base row matches in another table."""
    counted = other.groupBy(*keys).agg(F.count(F.lit(1)).alias(MATCHES))
    return base.join(counted, list(keys), "left")


def repeat_rows(counted: DataFrame, chunk: int = MATCH_CHUNK) -> DataFrame:
    """Repeat each row as often as it has matches, and once when it has none.

    Matches are cut into chunks that are spread over the cluster before rows are repeated, so that a row with very many
    of them is repeated by several tasks.
    """
    one = F.lit(1).cast("bigint")
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = counted.withColumn(MATCHES, F.coalesce(MATCHES, one))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col(MATCHES) - 1, F.lit(chunk).cast("bigint"))
    spread = counted.withColumn("_start", F.explode(starts)).repartition(tasks)
    spread = spread.withColumn(MATCHES, F.least(F.lit(chunk), F.col(MATCHES) - F.col("_start"))).drop("_start")
    return spread.withColumn("_copy", F.explode(F.sequence(one, MATCHES))).drop(MATCHES, "_copy")


def repeat_by_matches(
    base: DataFrame, other: DataFrame, keys: Sequence[str], chunk: int = MATCH_CHUNK
) -> DataFrame:
    """Left join to a table of which only the row multiplicity matters, by its counts per key."""
    return repeat_rows(count_matches(base, other, keys), chunk).select(*base.columns)


def joined_to_itself(
    df: DataFrame, keys: Sequence[str], left: Sequence[str], right: Sequence[str]
) -> DataFrame:
    """A table joined to itself: some columns of a row next to others of every row with its key.

    Rows with a null key keep their own columns. A repeated key gives every combination of its rows.
    """
    return df.select(*keys, *left).join(df.select(*keys, *right), list(keys), "left")


def attach_summary(base: DataFrame, lookup: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Join a keyless lookup that every row meets in full.

    All rows meet the same lookup rows, so its averages, minima and maxima are one global row, computed once
    as a scalar subquery. An empty lookup gives nulls, as a left join would.
    """
    packed = F.struct(*[measure.alias(name) for name, measure in measures.items()]).alias("summary")
    with_summary = base.withColumn("_summary", lookup.agg(packed).scalar())
    return with_summary.select(*base.columns, *[F.col("_summary")[name].alias(name) for name in measures])


def first_rows(df: DataFrame, order_by: Sequence[str], limit: int) -> DataFrame:
    """A capped table that is the same on every run: the first rows in key order."""
    return df.orderBy(*order_by).limit(limit)
