"""Declarative data-quality checks.

All row-level checks of a table share one pass. Results are rows, so they can be stored and compared.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martflow.operators.conform import union_all

RESULT_SCHEMA = "check_name string, column_name string, severity string, violations bigint"


@dataclass(frozen=True)
class NotNull:
    column: str
    severity: str = "warn"
    name = "not_null"

    def violated(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    """Value in a list; null is left to NotNull."""

    column: str
    values: Sequence[Any]
    severity: str = "warn"
    name = "accepted"

    def violated(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class InRange:
    column: str
    low: float
    high: float
    severity: str = "warn"
    name = "in_range"

    def violated(self) -> Column:
        return ~F.col(self.column).between(self.low, self.high)


@dataclass(frozen=True)
class Unique:
    """No value occurs twice; counts the values that do."""

    column: str
    severity: str = "warn"
    name = "unique"


class CheckFailed(Exception):
    """A check of severity ``error`` found violations."""


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def run_checks(df: DataFrame, checks: Sequence[NotNull | Accepted | InRange | Unique]) -> DataFrame:
    """One result row per check with its number of violations."""
    row_checks = [c for c in checks if not isinstance(c, Unique)]
    results = []
    if row_checks:
        counts = df.agg(*[F.count_if(c.violated()).alias(f"v{i}") for i, c in enumerate(row_checks)])
        lines = [
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.column).alias("column_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, c in enumerate(row_checks)
        ]
        results.append(counts.select(F.explode(F.array(*lines)).alias("r")).select("r.*"))
    unique = [c for c in checks if isinstance(c, Unique)]
    if unique:
        results.append(_repeated_values(df, unique))
    return union_all(results)


def _repeated_values(df: DataFrame, checks: Sequence[Unique]) -> DataFrame:
    """One result row per uniqueness check. Grouping sets count the values of all columns in one shuffle."""
    columns = sorted({c.column for c in checks})
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    keys = df.select(*[F.col(c).alias(names[c]) for c in columns])
    told = [F.grouping(names[c]).alias(f"g{i}") for i, c in enumerate(columns)]
    counted = keys.groupingSets([[names[c]] for c in columns], *names.values()).agg(F.count(F.lit(1)).alias("n"), *told)
    # A set's own column is the one that it groups by; its null is no value.
    own = {c: (F.col(f"g{i}") == 0) & F.col(names[c]).isNotNull() for i, c in enumerate(columns)}
    sums = counted.where("n > 1").agg(*[F.count_if(own[c]).alias(f"v{i}") for i, c in enumerate(columns)])
    lines = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.severity).alias("severity"),
            F.col(f"v{columns.index(c.column)}").alias("violations"),
        )
        for c in checks
    ]
    return sums.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def observe_checks(df: DataFrame, checks: Sequence[NotNull | Accepted | InRange]) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """The frame with its checks counted while it is written, and a function that tells the counts afterwards.

    Put it right under the write, whose tasks count once. The result rows are those of ``run_checks``.
    """
    if not checks:
        return df, lambda: []
    observation = Observation()
    watched = df.observe(observation, *[F.count_if(c.violated()).alias(f"v{i}") for i, c in enumerate(checks)])
    return watched, lambda: [(c.name, c.column, c.severity, observation.get[f"v{i}"]) for i, c in enumerate(checks)]


def enforce(results: DataFrame) -> list[str]:
    """Warnings as text; raises if a check of severity ``error`` failed. Holds one line per failed check."""
    failed = results.where("violations > 0").collect()
    lines = [f"{r.check_name}({r.column_name}): {r.violations}" for r in failed]
    errors = [line for r, line in zip(failed, lines) if r.severity == "error"]
    if errors:
        raise CheckFailed("; ".join(errors))
    return lines


def contract_report(df: DataFrame, expected: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Compare a frame's columns with a contract of names, or of names and types."""
    spark = df.sparkSession
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    typed = isinstance(expected, Mapping)
    rows = []
    for name in expected:
        if name not in found:
            status = "missing"
        elif typed and expected[name] != found[name]:
            status = "type differs"
        else:
            status = "ok"
        rows.append((name, expected[name] if typed else None, found.get(name), status))
    rows += [(name, None, kind, "unexpected") for name, kind in found.items() if name not in set(expected)]
    return spark.createDataFrame(
        rows, "column_name string, expected_type string, found_type string, status string"
    )


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Row counts of a source and of what was loaded from it."""
    sides = union_all(
        [
            source.agg(F.count(F.lit(1)).alias("n")).select(F.lit("source").alias("side"), "n"),
            target.agg(F.count(F.lit(1)).alias("n")).select(F.lit("target").alias("side"), "n"),
        ]
    )
    counts = sides.agg(
        F.max(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
        F.max(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows"),
    )
    return counts.withColumn("difference", F.col("source_rows") - F.col("target_rows"))


# Buckets of keys whose checksums are compared first.
KEY_BUCKETS = 4096


def differing_keys(
    source: DataFrame, target: DataFrame, keys: Sequence[str], slice_by: str | None = None
) -> DataFrame:
    """Keys whose rows differ between a source and what was loaded from it: the keys, n_source, n_target, kind.

    ``kind`` is missing, extra, count (another number of rows) or changed. Both frames are compared on the columns of the
    source, whatever the order of rows and columns; equal nulls are equal. First come checksums of each slice, a column by which both are
    partitioned, so that equal slices are read once and then pruned; then of buckets of keys; then of the keys of
    the buckets that differ, the only rows that are shuffled. Sums of two 64-bit hashes stand for the rows.
    """
    columns = sorted(source.columns)
    sides = {"source": source.select(*columns), "target": target.select(*columns)}

    def restricted(condition: Column) -> None:
        for side in sides:
            sides[side] = sides[side].where(condition)

    if slice_by is not None:
        # One row for each slice that differs.
        found = [r["_at"] for r in _unlike(sides, F.col(slice_by), columns).collect()]
        wanted = F.col(slice_by).isin([v for v in found if v is not None])
        restricted(wanted | F.col(slice_by).isNull() if None in found else wanted)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    found = [r["_at"] for r in _unlike(sides, bucket, columns).collect()]
    restricted(bucket.isin(found))
    unlike = _unlike(sides, F.struct(*keys), columns)
    n_source, n_target = (F.coalesce(f"n_{side}", F.lit(0)) for side in ("source", "target"))
    kind = (
        F.when(n_target == 0, "missing").when(n_source == 0, "extra").when(n_source != n_target, "count").otherwise("changed")
    )
    return unlike.select("_at.*", n_source.alias("n_source"), n_target.alias("n_target"), kind.alias("kind"))


def _unlike(sides: Mapping[str, DataFrame], by: Column, columns: Sequence[str]) -> DataFrame:
    """Groups whose number of rows or checksums differ: _at, n_source, n_target."""
    # Nulls leave a hash as it is, so their places are hashed too.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    hashes = [F.xxhash64(*columns, nulls), F.xxhash64(nulls, *reversed(columns), F.lit(1))]
    counted = [
        frame.groupBy(by.alias("_at")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(h.cast("decimal(20,0)")).alias(f"h{i}") for i, h in enumerate(hashes)]
        )
        .select("_at", *[F.col(c).alias(f"{c}_{side}") for c in ("n", "h0", "h1")])
        .withColumnRenamed("_at", f"at_{side}")
        for side, frame in sides.items()
    ]
    both = counted[0].join(counted[1], F.col("at_source").eqNullSafe(F.col("at_target")), "full_outer")
    same = [F.col(f"{c}_source").eqNullSafe(F.col(f"{c}_target")) for c in ("n", "h0", "h1")]
    there = F.when(F.col("n_source").isNotNull(), F.col("at_source")).otherwise(F.col("at_target"))
    return both.where(~(same[0] & same[1] & same[2])).select(there.alias("_at"), "n_source", "n_target")


def profile(df: DataFrame) -> DataFrame:
    """Type, row count and null count of every column in one pass, one result row per column."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_nulls_{i}") for i, c in enumerate(df.columns)],
    )
    lines = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_nulls_{i}").alias("n_nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counted.select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def preview(df: DataFrame, rows: int = 2) -> DataFrame:
    return df.limit(rows)
