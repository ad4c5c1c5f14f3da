"""Named queries over the test tables, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martflow.bindings.testdata import Binding
from martflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the binding under a name."""

    def register(build: Callable[[Binding], DataFrame]):
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return build(Binding(prepare(spark), directory))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table_name(label: str) -> str:
    return f"martflow_{label}_{uuid.uuid4().hex[:12]}"
