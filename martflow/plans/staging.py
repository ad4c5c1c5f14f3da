"""Staging views: seed tables picked to their contract, streamed tables under snake_case names."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.scalar import days_between, month_floor, percent_of
from martflow.operators.conform import audited, pick
from martflow.operators.quality import NotNull, Unique

# Columns each staging view takes from its seed table.
SEED_COLUMNS = {
    "stg_crop": ["crop_id", "crop_name", "crop_type", "growing_season", "water_needs"],
    "stg_farm": ["farm_id", "farm_name", "farm_location", "farm_size", "established_date"],
    "stg_harvest": ["harvest_id", "farm_id", "crop_id", "yield_amount"],
    "stg_production": ["production_id", "farm_id", "crop_id", "quantity_produced", "cost"],
    "stg_soil": ["soil_id", "farm_id", "ph_level", "organic_matter"],
    "stg_sustainability": ["sustainability_id", "farm_id", "water_usage", "carbon_footprint", "pesticide_usage"],
    "stg_weather": ["weather_id", "temperature", "precipitation", "humidity"],
    "stg_yield": ["yield_id", "farm_id", "crop_id", "harvest_id", "yield_per_hectare", "year"],
}

# Keys that must be present and unique.
SEED_KEYS = {
    "stg_weather": "weather_id",
    "stg_soil": "soil_id",
    "stg_harvest": "harvest_id",
    "stg_production": "production_id",
    "stg_yield": "yield_id",
    "stg_sustainability": "sustainability_id",
}

# Names of the streamed tables -> names of their staging views.
FARM_ANALYSIS_NAMES = {
    "Farm_ID": "farm_id",
    "Farm_Type": "farm_type",
    "avg_Farm_Size_Acres": "avg_farm_size_acres",
    "avg_Soil_Moisture": "avg_soil_moisture",
    "avg_Soil_Temperature": "avg_soil_temperature",
}
CROP_ANALYSIS_NAMES = {
    "Crop_Type": "crop_type",
    "Crop_Variety": "crop_variety",
    "avg_Expected_Yield": "avg_expected_yield",
    "avg_Actual_Yield": "avg_actual_yield",
    "avg_Growing_Period_Days": "avg_growing_period_days",
}
FULL_DATA_NAMES = {
    "Farm_ID": "farm_id",
    "Crop_ID": "crop_id",
    "Farm_Type": "farm_type",
    "Farm_Size_Acres": "farm_size_acres",
    "Planting_Date": "planting_date",
    "Harvest_Date": "harvest_date",
    "Expected_Yield": "expected_yield",
    "Actual_Yield": "actual_yield",
    "Soil_Moisture": "soil_moisture",
    "Soil_Temperature": "soil_temperature",
    "Sustainability_Score": "sustainability_score",
    "year": "year",
    "month": "month",
}


def stage_seed(seed: DataFrame, view: str, as_of: datetime | date) -> DataFrame:
    return audited(pick(seed, SEED_COLUMNS[view]), as_of)


def key_checks(view: str, severity: str = "warn") -> list[Unique | NotNull]:
    return [Unique(SEED_KEYS[view], severity), NotNull(SEED_KEYS[view], severity)]


def stage_farm_analysis(table: DataFrame, as_of: datetime | date) -> DataFrame:
    return audited(pick(table, FARM_ANALYSIS_NAMES), as_of)


def stage_crop_analysis(table: DataFrame, as_of: datetime | date) -> DataFrame:
    return audited(pick(table, CROP_ANALYSIS_NAMES), as_of)


def stage_full_data(table: DataFrame, as_of: datetime | date) -> DataFrame:
    staged = pick(table, FULL_DATA_NAMES).withColumns(
        {
            "planting_month": month_floor("planting_date"),
            "growing_period_days": days_between("planting_date", "harvest_date"),
            "yield_percentage": percent_of("actual_yield", "expected_yield"),
        }
    )
    return audited(staged, as_of)


def season_year(staged: DataFrame, date_column: str) -> DataFrame:
    """Take ``year`` and ``month`` from another date, such as planting instead of message time."""
    return staged.withColumns({"year": F.year(date_column), "month": F.month(date_column)})
