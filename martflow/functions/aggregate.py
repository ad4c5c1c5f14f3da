"""Aggregate expressions.

``exact`` makes a sum independent of the order in which partitions arrive, so repeated runs agree to the last
bit. A number of decimals sums a measure as scaled integers, as fast as doubles; it suits measures and ratios of
single records (an overflow fails the job). A decimal type suits amounts already added up; it is several times
slower. Without it the usual double arithmetic is used.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from martflow.functions.scalar import SEASON_MONTHS, ColumnLike, col, growth_percent, percent_of, safe_ratio

# Months of each season, winter written out.
PIVOT_MONTHS = {**SEASON_MONTHS, "Winter": (12, 1, 2)}


Exact = int | str | None


@dataclass(frozen=True)
class FixedPoint:
    """How exactly to sum the measures of single records, their ratios, and amounts already added up."""

    measure: Exact = 4
    ratio: Exact = 10
    amount: Exact = "decimal(18,4)"


def widest(exact: Exact) -> Exact:
    """The decimal type with the same decimals and all digits there are, for sums of weighted sums."""
    if exact is None:
        return None
    decimals = exact if isinstance(exact, int) else int(exact.rstrip(")").split(",")[1])
    return f"decimal(38,{decimals})"


# Decimals that one integer sum holds; further ones go to a second sum, so that neither overflows.
FIRST_DECIMALS = 5


def integer_total(value: Column, decimals: int) -> Column:
    """Sum at a number of decimals, by sums of integers."""
    if decimals <= FIRST_DECIMALS:
        unit = float(10**decimals)
        return F.sum(F.rint(value * unit).cast("bigint")) / unit
    finer = 10 ** (decimals - FIRST_DECIMALS)
    scaled = value * float(10**FIRST_DECIMALS)
    first = F.sum(F.floor(scaled)).cast("decimal(20,0)")
    second = F.sum(F.rint((scaled - F.floor(scaled)) * float(finer)).cast("bigint"))
    return (first * F.lit(finer).cast("decimal(10,0)") + second).cast("double") / float(10**decimals)


def total(value: ColumnLike, exact: Exact = None) -> Column:
    if exact is None:
        return F.sum(col(value))
    if isinstance(exact, int):
        return integer_total(col(value).cast("double"), exact)
    return F.sum(col(value).cast(exact)).cast("double")


def mean(value: ColumnLike, exact: Exact = None) -> Column:
    if exact is None:
        return F.avg(col(value))
    return total(value, exact) / F.nullif(F.count(col(value)), F.lit(0))


def mean_where(condition: Column, value: ColumnLike, exact: Exact = None) -> Column:
    """Mean over the rows that meet a condition."""
    return mean(F.when(condition, col(value)), exact)


def mean_or(value: ColumnLike, default: float, exact: Exact = None) -> Column:
    """Mean with missing values read as ``default``."""
    return mean(F.coalesce(col(value), F.lit(default)), exact)


def mean_of_ratio(numerator: ColumnLike, denominator: ColumnLike, exact: Exact = None) -> Column:
    return mean(safe_ratio(numerator, denominator), exact)


def ratio_of_means_percent(numerator: ColumnLike, denominator: ColumnLike, exact: Exact = None) -> Column:
    return percent_of(mean(numerator, exact), mean(denominator, exact))


def mean_since_year(year: ColumnLike, first_year: int, value: ColumnLike, exact: Exact = None) -> Column:
    return mean_where(col(year) >= first_year, value, exact)


def mean_in_year(year: ColumnLike, wanted: int, value: ColumnLike, exact: Exact = None) -> Column:
    return mean_where(col(year) == wanted, value, exact)


def year_over_year_percent(
    year: ColumnLike, as_of_year: int, value: ColumnLike, exact: Exact = None
) -> Column:
    return growth_percent(
        mean_in_year(year, as_of_year, value, exact), mean_in_year(year, as_of_year - 1, value, exact)
    )


def season_means(month: ColumnLike, value: ColumnLike, exact: Exact = None) -> Mapping[str, Column]:
    """Season pivot as conditional means: one pass, no extra grouping key."""
    return {
        season.lower(): mean_where(col(month).isin(*months), value, exact)
        for season, months in PIVOT_MONTHS.items()
    }


def distinct_count(value: ColumnLike, approximate: bool = False, apart: bool = False) -> Column:
    """Number of distinct values. With ``apart``, given for a column's name, the values are shuffled on rows of their own.

    Otherwise each of them carries the sums that stand beside it in the aggregate; those then combine map-side.
    """
    if apart:
        return F.expr(f"count(DISTINCT `{value}`) FILTER (WHERE `{value}` IS NOT NULL)")
    return F.approx_count_distinct(col(value)) if approximate else F.count_distinct(col(value))
