"""One run from seeds to checked marts: stage, check, build, store, check what was stored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.aggregate import FixedPoint
from martflow.operators.conform import union_all
from martflow.operators.quality import RESULT_SCHEMA, InRange, NotNull, Unique, enforce, observe_checks, run_checks
from martflow.plans.marts import all_marts
from martflow.plans.staging import SEED_KEYS, key_checks, stage_seed
from martflow.sinks.files import write_tables
from martflow.workspace import run_folder

# What every stored mart is held to.
MART_CHECKS = {
    "farm_performance": [NotNull("farm_id"), NotNull("farm_type")],
    "crop_performance": [NotNull("crop_type"), NotNull("crop_name")],
    "seasonal_performance": [NotNull("farm_id"), NotNull("crop_id"), InRange("season_performance_rating", 1, 5)],
    "sustainability_metrics": [NotNull("farm_id"), InRange("sustainability_tier", 1, 5)],
}


@dataclass(frozen=True)
class Run:
    """Where the marts are, one row per check, and a line for each warning."""

    paths: dict[str, str]
    results: DataFrame
    warnings: list[str]


def checked(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence]) -> DataFrame:
    """The checks of several tables as one result, columns named ``table.column``. One row per check."""
    found = union_all(
        [
            run_checks(tables[name], own).withColumn("column_name", F.concat(F.lit(f"{name}."), F.col("column_name")))
            for name, own in checks.items()
        ]
    )
    # As rows of its own, so that nothing counts again when the result is read.
    return found.sparkSession.createDataFrame(found.collect(), RESULT_SCHEMA)


def run_marts(
    records: DataFrame,
    seeds: Mapping[str, DataFrame],
    as_of: datetime,
    prefix: str,
    exact: FixedPoint | None = None,
    severity: str = "warn",
    mart_checks: Mapping[str, Sequence] = MART_CHECKS,
) -> Run:
    """Stage the seeds, check their keys, build and store all marts, and check those.

    ``severity`` is that of the key checks. A failed check of severity ``error`` raises ``CheckFailed``; for a key of the
    seeds that is before any mart is built. Intermediate tables are gone when the run ends, however it ends.
    """
    spark = records.sparkSession
    with run_folder(spark):
        staged = {f"stg_{name}": stage_seed(seed, f"stg_{name}", as_of) for name, seed in seeds.items()}
        keys = checked(staged, {view: key_checks(view, severity) for view in SEED_KEYS if view in staged})
        warnings = enforce(keys)
        # Row checks are counted by the tasks that write; only uniqueness needs what is stored.
        marts = all_marts(records, staged, as_of, exact)
        told = {}
        for name, checks in mart_checks.items():
            marts[name], told[name] = observe_checks(marts[name], [c for c in checks if not isinstance(c, Unique)])
        paths = write_tables(marts, prefix)
        rows = [(n, f"{name}.{column}", *rest) for name, of in told.items() for n, column, *rest in of()]
        content = spark.createDataFrame(rows, RESULT_SCHEMA)
        unique = {name: own for name, checks in mart_checks.items() if (own := [c for c in checks if isinstance(c, Unique)])}
        if unique:
            content = content.unionByName(checked({name: spark.read.parquet(paths[name]) for name in unique}, unique))
        warnings += enforce(content)
    return Run(paths, keys.unionByName(content), warnings)
