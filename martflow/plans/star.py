"""Dimensions and facts cut from flat records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.bindings import agri
from martflow.functions.scalar import days_between
from martflow.operators.conform import latest_by_key, parse_dates, rename
from martflow.sinks.files import write_tables


def conformed(records: DataFrame) -> DataFrame:
    """Records under batch names, with real dates."""
    return parse_dates(rename(records, agri.STREAM_NAMES), agri.DATE_COLUMNS)


def dimension(
    records: DataFrame, name: str, latest_on: Sequence[str] | None = None, event_time: str = "timestamp"
) -> DataFrame:
    """A dimension's distinct rows; with ``latest_on`` the latest row of each of those keys instead."""
    columns = agri.DIMENSIONS[name]
    if latest_on is None:
        return records.select(*columns).distinct()
    newest = latest_by_key(records.select(*dict.fromkeys([*columns, event_time])), latest_on, event_time)
    return newest.select(*columns)


def dimensions(records: DataFrame) -> dict[str, DataFrame]:
    return {name: dimension(records, name) for name in agri.DIMENSIONS}


def production_fact(records: DataFrame) -> DataFrame:
    return records.select(*agri.FACTS["farm_production"]).withColumns(
        {
            "Planting_Year": F.year("Planting_Date"),
            "Planting_Month": F.month("Planting_Date"),
            "Harvest_Year": F.year("Harvest_Date"),
            "Harvest_Month": F.month("Harvest_Date"),
            "Growth_Period_Days": days_between("Planting_Date", "Harvest_Date"),
        }
    )


def fact(records: DataFrame, name: str) -> DataFrame:
    return production_fact(records) if name == "farm_production" else records.select(*agri.FACTS[name])


def facts(records: DataFrame) -> dict[str, DataFrame]:
    return {name: fact(records, name) for name in agri.FACTS}


def write_star(records: DataFrame, prefix: str) -> dict[str, str]:
    """Write all dimensions and facts.

    Each of them scans only its own columns, so records read from a columnar table are not kept in between.
    Records that are costly to compute should be passed through ``workspace.materialise`` first; stored by crop, they are
    not shuffled for the four dimensions of farm and crop, nor for that of the crop.
    """
    shaped = conformed(records)
    tables = {f"dim_{name}": df for name, df in dimensions(shaped).items()}
    tables |= {f"fact_{name}": df for name, df in facts(shaped).items()}
    return write_tables(tables, prefix, compression="zstd")
