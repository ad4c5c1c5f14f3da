"""Roll-ups kept up to date from what their source has committed since: sums that merge, not means.

For every commit of the source its new rows alone are aggregated, by partition value and key, to counts, sums of scaled integers
and bitmaps of ids. These rows are appended to a state table, whose log holds the version of the source up to which it
counts, so no commit counts twice. The result merges the state, and equals the roll-up over all records to the last bit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.functions import scalar
from martflow.functions.aggregate import FIRST_DECIMALS, PIVOT_MONTHS, FixedPoint
from martflow.sinks.committed import TARGET_BYTES, CommittedTable

BUCKET, BITS = "_id_bucket", "_id_bits"
WRITER = "refresh"


@dataclass(frozen=True)
class Measure:
    """A value of single records, and the decimals at which it is summed."""

    value: Column
    decimals: int = 4

    @property
    def split(self) -> bool:
        """Whether its sum is kept in two integers, as ``aggregate.integer_total`` does."""
        return self.decimals > FIRST_DECIMALS

    def parts(self) -> dict[str, Column]:
        value = self.value.cast("double")
        if not self.split:
            return {"n": F.count(value), "s": F.sum(F.rint(value * float(10**self.decimals)).cast("bigint"))}
        scaled = value * float(10**FIRST_DECIMALS)
        finer = F.rint((scaled - F.floor(scaled)) * float(10 ** (self.decimals - FIRST_DECIMALS)))
        return {"n": F.count(value), "s": F.sum(F.floor(scaled)), "f": F.sum(finer.cast("bigint"))}

    def total(self, part: Callable[[str], Column]) -> Column:
        """The sum, from summed parts."""
        if not self.split:
            return part("s") / float(10**self.decimals)
        finer = F.lit(10 ** (self.decimals - FIRST_DECIMALS)).cast("decimal(10,0)")
        return (part("s").cast("decimal(20,0)") * finer + part("f")).cast("double") / float(10**self.decimals)


@dataclass(frozen=True)
class Shown:
    """A column of a result: the mean or the total of a measure, over the state rows whose keys meet a condition."""

    measure: str
    where: Column | None = None
    total: bool = False


@dataclass(frozen=True)
class Rollup:
    """What is kept of records by keys: sums of measures, and the distinct ids of an integer column."""

    keys: Sequence[str]
    measures: Mapping[str, Measure]
    distinct: str | None = None

    def state_table(self, spark: SparkSession, path: str, partition: str) -> CommittedTable:
        return CommittedTable(spark, path, partition)

    def _parts(self) -> dict[str, Column]:
        return {f"{p}_{name}": told for name, m in self.measures.items() for p, told in m.parts().items()}

    def state_of(self, rows: DataFrame, partition: str) -> DataFrame:
        """Mergeable counts of some rows: one row for each partition value, key and bucket of ids."""
        bucket, bits = F.lit(0).cast("bigint"), F.lit(None).cast("binary")
        if self.distinct:
            if not isinstance(rows.schema[self.distinct].dataType, T.IntegralType):
                raise ValueError(f"{self.distinct} holds no integers, so its values can't be counted by bitmaps")
            bucket = F.bitmap_bucket_number(self.distinct)
            bits = F.bitmap_construct_agg(F.bitmap_bit_position(self.distinct))
        grouped = rows.groupBy(partition, *[k for k in self.keys if k != partition], bucket.alias(BUCKET))
        counts = [told.alias(name) for name, told in self._parts().items()]
        return grouped.agg(*counts, bits.alias(BITS)) if self.distinct else grouped.agg(*counts).withColumn(BITS, bits)

    def fold(self, partition: str) -> Callable[[DataFrame], DataFrame]:
        sums = [F.sum(name).alias(name) for name in self._parts()]
        keys = [partition, *[k for k in self.keys if k != partition], BUCKET]
        return lambda state: state.groupBy(*keys).agg(*sums, F.bitmap_or_agg(BITS).alias(BITS))

    def result(self, state: DataFrame, by: Sequence[str] | None = None, shown: Mapping[str, Shown] | None = None) -> DataFrame:
        """The roll-up by all or some of the keys.

        By default ``avg_`` of every measure. ``n_`` of the distinct column counts its ids.
        """
        by = list(self.keys if by is None else by)
        shown = shown or {f"avg_{name}": Shown(name) for name in self.measures}
        sums, columns = [], []
        for place, (name, one) in enumerate(shown.items()):
            measure = self.measures[one.measure]
            for part in measure.parts():
                value = F.col(f"{part}_{one.measure}")
                sums.append(F.sum(value if one.where is None else F.when(one.where, value)).alias(f"{part}{place}"))
            whole = measure.total(lambda part, place=place: F.sum(f"{part}{place}"))
            if not one.total:
                whole = whole / F.nullif(F.sum(f"n{place}"), F.lit(0))
            columns.append(whole.alias(name))
        by_bucket = state.groupBy(*by, BUCKET).agg(*sums, F.bitmap_or_agg(BITS).alias(BITS))
        if self.distinct:
            columns.append(F.sum(F.coalesce(F.bitmap_count(BITS), F.lit(0))).alias(f"n_{self.distinct}"))
        return by_bucket.groupBy(*by).agg(*columns)


def refresh(
    source: CommittedTable, state: CommittedTable, rollup: Rollup, shape: Callable[[DataFrame], DataFrame] = lambda df: df
) -> int | None:
    """Add what the source has committed since the last refresh to the state. Returns the state's version, if there was any.

    Only files of those commits are read. The source has to keep its versions until they are counted.
    """
    done, latest = state.version().batches.get(WRITER, 0), source.version().number
    if latest <= done:
        return None
    new = rollup.state_of(shape(source.since(done, latest)), source.partition)
    return state.append(new, WRITER, latest, by_range=False)


def compact_state(state: CommittedTable, rollup: Rollup, target_bytes: int = TARGET_BYTES) -> int | None:
    """Merge what refreshes have left for the same partition value, key and bucket."""
    return state.compact(target_bytes, rollup.fold(state.partition))


# The records' side of the marts

RECORD_MEASURES = [
    "soil_moisture", "soil_temperature", "actual_yield", "expected_yield", "yield_percentage", "sustainability_score",
    "growing_period_days",
]


def farm_rollup(exact: FixedPoint) -> Rollup:
    """What the farm mart needs of the records, by farm, crop type and year."""
    measures = {m: Measure(F.col(m), exact.measure) for m in RECORD_MEASURES}
    measures["yield_per_acre"] = Measure(scalar.safe_ratio("actual_yield", "farm_size_acres"), exact.ratio)
    return Rollup(["farm_id", "crop_type", "year"], measures)


def farm_side(state: DataFrame, rollup: Rollup, as_of_year: int) -> DataFrame:
    """The records' side of ``marts.farm_performance``."""
    shown = {
        **{f"avg_{m}": Shown(m) for m in RECORD_MEASURES if m != "growing_period_days"},
        "plain_total": Shown("actual_yield", total=True),
        "recent_avg_yield": Shown("actual_yield", F.col("year") >= as_of_year - 1),
        "avg_growing_period": Shown("growing_period_days"),
        "yield_per_acre": Shown("yield_per_acre"),
    }
    return rollup.result(state, ["farm_id", "crop_type"], shown).withColumnRenamed("crop_type", "farm_type")


def crop_rollup(exact: FixedPoint) -> Rollup:
    """What the crop mart needs of the records, by crop type, year and month, with the farms as bitmaps."""
    wanted = [m for m in RECORD_MEASURES if not m.startswith("soil")]
    return Rollup(["crop_type", "year", "month"], {m: Measure(F.col(m), exact.measure) for m in wanted}, "farm_id")


def crop_side(state: DataFrame, rollup: Rollup, as_of_year: int) -> DataFrame:
    """The records' side of ``marts.crop_performance``."""
    shown = {
        **{f"avg_{m}": Shown(m) for m in rollup.measures},
        "current_year_yield": Shown("actual_yield", F.col("year") == as_of_year),
        "previous_year_yield": Shown("actual_yield", F.col("year") == as_of_year - 1),
        **{f"{s.lower()}_yield": Shown("actual_yield", F.col("month").isin(*m)) for s, m in PIVOT_MONTHS.items()},
    }
    return rollup.result(state, ["crop_type"], shown).withColumnRenamed("n_farm_id", "farm_count")
