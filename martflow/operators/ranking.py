"""Row numbers and changes between periods at any size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.workspace import materialise

SALT = "_salt"
ROW = "_row"


@dataclass(frozen=True)
class Rank:
    """``row_number`` by one measure, descending, nulls last, with further keys to settle ties."""

    name: str
    by: str
    ties: Sequence[str]
    within: Sequence[str] = field(default=())

    @property
    def order(self) -> list[Column]:
        return [F.col(self.by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in self.ties]]


def window_rank(df: DataFrame, rank: Rank) -> DataFrame:
    """Rank with a plain window, which takes one task per group: the definition that tests compare with."""
    window = Window.partitionBy(*rank.within).orderBy(*rank.order)
    return df.withColumn(rank.name, F.row_number().over(window))


def salted(df: DataFrame) -> DataFrame:
    """The rows as a stored table, with a number of their own and a random number each.

    The numbers are stored before any shuffle depends on them, so a task repeated after a lost executor sends its
    rows to the same places.
    """
    return materialise(df.withColumn(ROW, F.monotonically_increasing_id()).withColumn(SALT, F.rand(17)), "to-rank")


def ranged_rank(df: DataFrame, rank: Rank) -> DataFrame:
    """The same numbers from a distributed sort of ``salted`` rows.

    Rows are range-partitioned and sorted by (group, order). A row's number is its distance from the first row
    of its group in its partition, plus the group's rows in earlier partitions. Only those counts, one row per
    group and partition, go through a window. The salt is the last sort key and splits rows that are equal in
    every other one; the sorted table is written out, so both passes see the same placement.
    """
    keys = [F.col(c).asc_nulls_last() for c in rank.within] + rank.order + [F.col(SALT)]
    placed = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_position", 33)),
        "ranked",
    )
    spans = placed.groupBy("_part", *rank.within).agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy(*rank.within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("_part").alias("_span_part"),
        *[F.col(c).alias(f"_span_{c}") for c in rank.within],
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    same_span = reduce(
        lambda a, b: a & b,
        [F.col(c).eqNullSafe(F.col(f"_span_{c}")) for c in rank.within],
        F.col("_part") == F.col("_span_part"),
    )
    ranked = placed.join(spans, same_span)
    return ranked.select(*df.columns, (F.col("_position") + F.col("_shift")).cast("bigint").alias(rank.name))


def add_ranks(df: DataFrame, ranks: Sequence[Rank]) -> DataFrame:
    """Add several row numbers. The input is stored once; only row number and sort keys are sorted for each rank."""
    base = salted(df)
    whole = base
    for rank in ranks:
        keys = dict.fromkeys([ROW, SALT, rank.by, *rank.ties, *rank.within])
        numbers = ranged_rank(base.select(*keys), rank).select(ROW, rank.name)
        whole = whole.join(numbers, ROW)
    return whole.select(*df.columns, *[rank.name for rank in ranks])


def change_from_previous(
    df: DataFrame, value: str, keys: Sequence[str], period: str, name: str, calendar: bool = False
) -> DataFrame:
    """Change of a measure since the previous period of the same key, for one row per key and period.

    The previous *available* period counts. With ``calendar`` only the directly preceding one does.
    """
    window = Window.partitionBy(*keys).orderBy(period)
    change = F.col(value) - F.lag(value, 1).over(window)
    if calendar:
        change = F.when(F.lag(period, 1).over(window) == F.col(period) - 1, change)
    return df.withColumn(name, change)
