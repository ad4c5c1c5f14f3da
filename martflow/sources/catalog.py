"""Catalog tables and named upstream results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


class ContractBroken(Exception):
    """A table lacks columns its contract promises."""


def source(spark: SparkSession, table: str, contract: Sequence[str] = ()) -> DataFrame:
    """A catalog table, checked against the columns it is expected to have."""
    df = spark.table(table)
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise ContractBroken(f"{table} lacks {', '.join(missing)}")
    return df


def as_views(tables: Mapping[str, DataFrame]) -> None:
    """Name upstream results for SQL users."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def view_of(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A named lazy result, kept as a view: nothing is stored."""
    build().createOrReplaceTempView(name)
    return spark.table(name)
