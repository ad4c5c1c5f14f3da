"""Analytical tables derived from the seed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions import scalar
from martflow.functions.aggregate import Exact, mean
from martflow.operators.conform import with_constants
from martflow.operators.joins import count_matches, one_per_key, repeat_rows, star

# Growing days of each season.
SEASON_DAYS = {"Annual": 365, "Spring": 90, "Summer": 100, "Fall": 80, "Winter": 120}
SEASON_DAYS_OTHERWISE = 90

# Planting and harvest day (month, day) of each season.
PLANTING_DAY = {"Spring": (3, 15), "Summer": (6, 15), "Winter": (11, 15), "Annual": (4, 1)}
PLANTING_DAY_OTHERWISE = (5, 1)
HARVEST_DAY = {"Spring": (6, 15), "Summer": (9, 15), "Winter": (2, 15), "Annual": (10, 1)}
HARVEST_DAY_OTHERWISE = (9, 1)

# Thresholds and labels of the derived attributes.
FERTILITY = ([(3, "High"), (1.5, "Medium")], "Low")
PESTICIDE = ([(50, "Chemical")], "Organic")
EQUIPMENT = ([(200, "Heavy Machinery"), (100, "Tractor")], "Manual Tools")
GRADE = ([(80, "A"), (60, "B"), (40, "C")], "D")
CERTIFICATION = ([(70, "Organic")], "Conventional")
YIELD_UNIT = "kg/hectare"
SUNLIGHT_HOURS = 8
FERTILIZER_AMOUNT = 100

# What stands in for a missing soil or sustainability record.
NO_SOIL = {"moisture": 60, "temperature": 55, "ph": 6.5}
NO_SUSTAINABILITY = {"score": 75, "irrigation": 200, "pesticide": 30, "carbon": 50, "water": 300}

# Columns of the table built from farms and crops alone.
FALLBACK_FARM = {"avg_Soil_Moisture": 60, "avg_Soil_Temperature": 55}
FALLBACK_CROP = {"avg_Expected_Yield": 100, "avg_Actual_Yield": 90, "avg_Growing_Period_Days": 90}

Tables = Mapping[str, DataFrame]


def soil_moisture(ph: scalar.ColumnLike) -> Column:
    return scalar.or_default(scalar.col(ph) * 10, NO_SOIL["moisture"])


def soil_temperature(ph: scalar.ColumnLike) -> Column:
    return scalar.or_default(scalar.col(ph) * 5 + 40, NO_SOIL["temperature"])


def farm_analysis(farms: DataFrame, soil: DataFrame) -> DataFrame:
    joined = farms.join(soil.select("farm_id", "ph_level"), "farm_id", "left")
    return joined.select(
        F.col("farm_id").alias("Farm_ID"),
        F.lit("Mixed").alias("Farm_Type"),
        F.col("farm_size").alias("avg_Farm_Size_Acres"),
        soil_moisture("ph_level").alias("avg_Soil_Moisture"),
        soil_temperature("ph_level").alias("avg_Soil_Temperature"),
    )


def growing_days(season: scalar.ColumnLike) -> Column:
    return scalar.value_map(season, SEASON_DAYS, SEASON_DAYS_OTHERWISE)


def crop_analysis_constant(crops: DataFrame) -> DataFrame:
    return crops.select(
        F.col("crop_type").alias("Crop_Type"),
        F.col("crop_name").alias("Crop_Variety"),
        F.lit(FALLBACK_CROP["avg_Expected_Yield"]).alias("avg_Expected_Yield"),
        F.lit(FALLBACK_CROP["avg_Actual_Yield"]).alias("avg_Actual_Yield"),
        growing_days("growing_season").alias("avg_Growing_Period_Days"),
    )


def crop_analysis_from_harvest(
    crops: DataFrame, harvest: DataFrame, exact: Exact = None
) -> DataFrame:
    joined = crops.join(harvest.select("crop_id", "yield_amount"), "crop_id", "left")
    grouped = joined.groupBy("crop_type", "crop_name", "growing_season").agg(
        mean("yield_amount", exact).alias("avg_Expected_Yield"),
        mean(F.col("yield_amount") * 0.9, exact).alias("avg_Actual_Yield"),
    )
    return grouped.select(
        F.col("crop_type").alias("Crop_Type"),
        F.col("crop_name").alias("Crop_Variety"),
        "avg_Expected_Yield",
        "avg_Actual_Yield",
        growing_days("growing_season").alias("avg_Growing_Period_Days"),
    )


def day_by_season(year: Column, season: Column, days: Mapping[str, tuple[int, int]], otherwise) -> Column:
    rules = [(season == name, scalar.date_in_year(year, day)) for name, day in days.items()]
    return scalar.first_match(rules, scalar.date_in_year(year, otherwise))


def season_dates(
    yields: DataFrame, crops: DataFrame, wrap_year: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Planting and harvest date of each yield's year by its crop's season, with further crop columns.

    A winter harvest lies before its planting, both being in one year; ``wrap_year`` moves it to the next.
    """
    joined = yields.select("farm_id", "crop_id", "year").join(
        crops.select("crop_id", "growing_season", *keep), "crop_id"
    )
    year, season = F.col("year"), F.col("growing_season")
    planting = day_by_season(year, season, PLANTING_DAY, PLANTING_DAY_OTHERWISE)
    harvest = day_by_season(year, season, HARVEST_DAY, HARVEST_DAY_OTHERWISE)
    if wrap_year:
        harvest = F.when(harvest < planting, F.add_months(harvest, 12)).otherwise(harvest)
    return joined.select(
        "farm_id", "crop_id", "year", planting.alias("planting_date"), harvest.alias("harvest_date"), *keep
    )


def seed_records(seeds: Tables, fanout: str = "reference", wrap_year: bool = False) -> DataFrame:
    """Farms, their dated crops, harvests, sustainability and soil, one row per record.

    What belongs to a farm, a crop or a harvest is put together first, so records are shuffled once for each.

    With ``fanout="reference"`` a record comes out once per matching harvest, yield of that harvest,
    sustainability and soil row. With ``"none"`` each of those counts once per key.
    """
    farms, crops, harvest = seeds["farm"], seeds["crop"], seeds["harvest"]
    sustainability, soil = seeds["sustainability"], seeds["soil"]
    seasons, names = crops.select("crop_id", "growing_season"), crops.select("crop_id", "crop_name", "crop_type")
    amounts = harvest.select("harvest_id", "farm_id", "crop_id", "yield_amount")
    if fanout == "none":
        amounts = one_per_key(amounts, ["farm_id", "crop_id"])
        sustainability, soil = one_per_key(sustainability, ["farm_id"]), one_per_key(soil, ["farm_id"])
        crop_side, most = one_per_key(crops, ["crop_id"]), 1
    else:
        crop_side = seasons.join(names, "crop_id")
        matched = seeds["yield"].where("harvest_id is not null")
        amounts = count_matches(amounts, matched, ["harvest_id"])
    use = sustainability.select("farm_id", "water_usage", "carbon_footprint", "pesticide_usage")
    ground = soil.select("farm_id", "ph_level", "organic_matter")
    farm_side = star(farms, [(use, ["farm_id"]), (ground, ["farm_id"])])
    dated = season_dates(seeds["yield"], crop_side, wrap_year, ["crop_name", "crop_type"]).drop("year")
    joined = dated.join(farm_side, "farm_id").join(amounts, ["farm_id", "crop_id"], "left")
    return joined if fanout == "none" else repeat_rows(joined)


def derived_attributes() -> dict[str, Column]:
    """Attributes that both full tables derive from a seed record, by their snake_case name."""
    score = scalar.or_default(100 - F.col("carbon_footprint"), NO_SUSTAINABILITY["score"])
    return {
        "soil_moisture": soil_moisture("ph_level"),
        "soil_temperature": soil_temperature("ph_level"),
        "sustainability_score": score,
        "year": F.year("planting_date"),
        "month": F.month("planting_date"),
        "yield_unit": F.lit(YIELD_UNIT),
        "soil_ph": scalar.or_default("ph_level", NO_SOIL["ph"]),
        "soil_fertility": scalar.band("organic_matter", *FERTILITY),
        "weather_sunlight": F.lit(SUNLIGHT_HOURS),
        "irrigation_amount": scalar.or_default(F.col("water_usage") * 10, NO_SUSTAINABILITY["irrigation"]),
        "fertilizer_amount": F.lit(FERTILIZER_AMOUNT),
        "pesticide_type": scalar.band("pesticide_usage", *PESTICIDE),
        "pesticide_amount": scalar.or_default("pesticide_usage", NO_SUSTAINABILITY["pesticide"]),
        "equipment_used": scalar.band("farm_size", *EQUIPMENT),
        "labor_hours": F.col("farm_size") * 2,
        "total_revenue": F.col("yield_amount") * 10,
        "quality_grade": scalar.band(score, *GRADE),
        "certification": scalar.band(score, *CERTIFICATION),
        "carbon_footprint": scalar.or_default("carbon_footprint", NO_SUSTAINABILITY["carbon"]),
        "water_footprint": scalar.or_default(F.col("water_usage") * 100, NO_SUSTAINABILITY["water"]),
    }


def contract_name(name: str) -> str:
    """Name of a derived attribute in the full_data contract."""
    if name in ("year", "month"):
        return name
    return "Soil_pH" if name == "soil_ph" else "_".join(part.capitalize() for part in name.split("_"))


def full_data(seeds: Tables, as_of: datetime, fanout: str = "reference") -> DataFrame:
    """The full_data contract from seeds, actual yield being nine tenths of the expected."""
    derived = {contract_name(name): value for name, value in derived_attributes().items()}
    return seed_records(seeds, fanout).select(
        F.col("farm_id").alias("Farm_ID"),
        F.col("crop_type").alias("Farm_Type"),
        F.col("farm_size").alias("Farm_Size_Acres"),
        F.col("crop_id").cast("string").alias("Crop_ID"),
        F.col("planting_date").alias("Planting_Date"),
        F.col("harvest_date").alias("Harvest_Date"),
        F.col("yield_amount").alias("Expected_Yield"),
        (F.col("yield_amount") * 0.9).alias("Actual_Yield"),
        F.col("farm_location").alias("Farm_Location"),
        F.col("farm_name").alias("Farmer_Contact"),
        *[value.alias(name) for name, value in derived.items()],
        F.lit(as_of).alias("timestamp"),
        F.lit(as_of).alias("created_at"),
    )


def staged_full_data(
    seeds: Tables, as_of: datetime, fanout: str = "reference", wrap_year: bool = False
) -> DataFrame:
    """Seed records in staging form, with an actual yield between half and 1.2 times the expected.

    The variation depends on the record's keys, so it is the same in every run and in every column derived
    from it.
    """
    varied = F.col("yield_amount") * (0.5 + scalar.stable_noise("farm_id", "crop_id") * 0.7)
    return seed_records(seeds, fanout, wrap_year).select(
        "farm_id",
        F.col("crop_id").cast("string").alias("crop_id"),
        F.col("farm_name").alias("farmer_contact"),
        "farm_location",
        F.year("established_date").alias("established_year"),
        "crop_type",
        "crop_name",
        F.col("farm_size").alias("farm_size_acres"),
        "planting_date",
        "harvest_date",
        F.col("yield_amount").alias("expected_yield"),
        F.when(F.col("yield_amount") > 0, varied).otherwise(100.0).alias("actual_yield"),
        *[value.alias(name) for name, value in derived_attributes().items()],
        F.lit(as_of).alias("timestamp"),
        F.lit(as_of).alias("created_at"),
        scalar.days_between("planting_date", "harvest_date").alias("growing_period_days"),
        scalar.percent_of(varied, "yield_amount").alias("yield_percentage"),
        F.lit(as_of).alias("loaded_at"),
    )


def fallback_farm_analysis(farms: DataFrame) -> DataFrame:
    named = farms.select(
        F.col("farm_id").alias("Farm_ID"), F.lit("Mixed").alias("Farm_Type"),
        F.col("farm_size").alias("avg_Farm_Size_Acres"),
    )
    return with_constants(named, FALLBACK_FARM)


def fallback_crop_analysis(crops: DataFrame) -> DataFrame:
    named = crops.select(F.col("crop_type").alias("Crop_Type"), F.col("crop_name").alias("Crop_Variety"))
    return with_constants(named, FALLBACK_CROP)
