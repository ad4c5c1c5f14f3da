"""Roll-ups of flat records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from martflow.bindings import agri
from martflow.functions.aggregate import Exact, mean
from martflow.operators.conform import add_date_parts
from martflow.sinks.files import write_partitioned, write_tables


def mean_rollup(
    records: DataFrame, keys: Sequence[str], measures: Sequence[str], exact: Exact = None
) -> DataFrame:
    """Means of several measures by keys, named ``avg_<measure>``."""
    return records.groupBy(*keys).agg(*[mean(m, exact).alias(f"avg_{m}") for m in measures])


def farm_analysis(records: DataFrame, exact: Exact = None) -> DataFrame:
    return mean_rollup(records, *agri.ROLLUPS["farm_analysis"], exact=exact)


def crop_analysis(records: DataFrame, exact: Exact = None) -> DataFrame:
    return mean_rollup(records, *agri.ROLLUPS["crop_analysis"], exact=exact)


def full_data(records: DataFrame, event_time: str = "timestamp") -> DataFrame:
    return add_date_parts(records, event_time)


def write_olap(records: DataFrame, prefix: str, event_time: str = "timestamp") -> dict[str, str]:
    """Write both roll-ups, and all records partitioned by year and month.

    The roll-ups scan only their own columns; see ``star.write_star`` for records that are costly to compute.
    """
    dated = full_data(records, event_time)
    written = write_tables({"farm_analysis": farm_analysis(dated), "crop_analysis": crop_analysis(dated)}, prefix)
    written["full_data"] = f"{prefix}/full_data"
    write_partitioned(dated, written["full_data"], ["year", "month"], ["Farm_ID", "Crop_ID"])
    return written
