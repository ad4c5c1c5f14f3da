"""Aggregates over joins that multiply rows, without forming the multiplied rows.

Joining several many-sided tables to one key pairs every row of each with every row of the others. Averages
and sums over that product depend only on each side's own sum, non-null count and row count per key: every
side's row is repeated once per combination of the other sides' rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.aggregate import Exact, total, widest


@dataclass(frozen=True)
class Side:
    """A many-sided table and its measures: name -> (row expression, how exactly to sum it)."""

    name: str
    rows: DataFrame
    key: str
    measures: Mapping[str, tuple[Column, Exact]]

    @property
    def copies(self) -> str:
        return f"_copies_{self.name}"

    def condensed(self) -> DataFrame:
        parts = [F.count(F.lit(1)).alias(self.copies)]
        for measure, (value, exact) in self.measures.items():
            parts += [total(value, exact).alias(f"_sum_{measure}"), F.count(value).alias(f"_n_{measure}")]
        return self.rows.groupBy(self.key).agg(*parts)


def repeats(names: Sequence[str]) -> Column:
    """How often the named sides' rows multiply the others; a side with no match counts once."""
    ones = [F.coalesce(F.col(f"_copies_{name}"), F.lit(1).cast("bigint")).cast("double") for name in names]
    return reduce(lambda a, b: a * b, ones, F.lit(1.0))


def join_condensed(base: DataFrame, sides: Sequence[Side]) -> DataFrame:
    """Left-join every side's per-key totals to the base."""
    for side in sides:
        base = base.join(side.condensed(), side.key, "left")
    return base


def product_mean(side: Side, met: Sequence[str], measure: str) -> Column:
    """Mean of a side's measure over its product with the sides it met, as an aggregate over joined totals."""
    exact = side.measures[measure][1]
    others = repeats([name for name in met if name != side.name])
    rows = total(F.col(f"_n_{measure}") * others, None if exact is None else "decimal(38,0)")
    weighted = total(F.col(f"_sum_{measure}") * others, widest(exact))
    return weighted / F.nullif(rows, F.lit(0.0))
