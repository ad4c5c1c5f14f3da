"""Schemas and names of the farm records."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

from martflow.operators.quality import Accepted, InRange

# Columns and types of a batch record.
RECORD_DDL = """
    Farm_ID string not null, Farm_Type string, Farm_Size_Acres double, Farm_Location string,
    Farmer_ID string, Farmer_Name string, Farmer_Contact string,
    Crop_ID string not null, Crop_Type string, Crop_Variety string, Planting_Date string, Harvest_Date string,
    Expected_Yield double, Actual_Yield double, Yield_Unit string,
    Soil_Type string, Soil_pH double, Soil_Moisture double, Soil_Temperature double, Soil_Fertility int,
    Weather_Temperature double, Weather_Humidity double, Weather_Rainfall double, Weather_Sunlight double,
    Irrigation_Method string, Irrigation_Amount double, Fertilizer_Type string, Fertilizer_Amount double,
    Pesticide_Type string, Pesticide_Amount double,
    Equipment_Used string, Labor_Hours double, Storage_Method string, Storage_Duration int,
    Transportation_Method string, Transportation_Distance int,
    Production_Cost double, Market_Price double, Total_Revenue double, Profit_Margin double,
    Quality_Grade string, Certification string, Carbon_Footprint double, Water_Footprint double,
    Sustainability_Score int, Market_Destination string, Customer_Segment string,
    Order_ID string, Order_Date string, Delivery_Date string, Order_Status string,
    Payment_Method string, Payment_Status string, message_id string, timestamp string
"""

# Columns that only streamed records carry.
STREAM_ONLY_DDL = """
    Growing_Period_Days long,
    Soil_Texture string, Soil_Nitrogen double, Soil_Phosphorus double, Soil_Potassium double,
    Soil_Organic_Matter double, Soil_Drainage string,
    Weather_Season string, Weather_Wind_Speed double, Weather_Extreme_Events string,
    Irrigation_Unit string, Irrigation_Frequency string, Irrigation_Water_Source string,
    Irrigation_Efficiency string, Irrigation_Automation string
"""

# Names in streamed records -> names in the batch record.
STREAM_NAMES = {
    "Soil_Fertility_Rating": "Soil_Fertility",
    "Weather_Sunlight_Hours": "Weather_Sunlight",
}

# Columns that hold dates, and those whose type differs between files.
DATE_COLUMNS = ["Planting_Date", "Harvest_Date", "Order_Date", "Delivery_Date"]
DRIFTING_COLUMNS = ["Pesticide_Amount", "Irrigation_Amount"]
LAKE_DRIFTING_COLUMNS = ["Pesticide_Amount", "Irrigation_Amount", "Fertilizer_Amount"]

# Columns of each dimension and fact.
DIMENSIONS = {
    "farm": [
        "Farm_ID", "Farm_Type", "Farm_Size_Acres", "Farm_Location", "Farmer_ID", "Farmer_Name", "Farmer_Contact",
    ],
    "crop": ["Crop_ID", "Crop_Type", "Crop_Variety"],
    "weather": [
        "Farm_ID", "Crop_ID", "Weather_Temperature", "Weather_Humidity", "Weather_Rainfall", "Weather_Sunlight",
    ],
    "soil": ["Farm_ID", "Soil_Type", "Soil_pH", "Soil_Moisture", "Soil_Temperature", "Soil_Fertility"],
    "yield": ["Crop_ID", "Farm_ID", "Expected_Yield", "Actual_Yield", "Yield_Unit"],
    "financial": ["Farm_ID", "Crop_ID", "Production_Cost", "Market_Price", "Total_Revenue", "Profit_Margin"],
    "sustainability": [
        "Farm_ID", "Crop_ID", "Carbon_Footprint", "Water_Footprint", "Sustainability_Score", "Certification",
    ],
}
FACTS = {
    "farm_production": [
        "Farm_ID", "Crop_ID", "Planting_Date", "Harvest_Date", "Actual_Yield", "Production_Cost", "Total_Revenue",
    ],
    "crop_yield": [
        "Crop_ID", "Farm_ID", "Soil_Type", "Irrigation_Method", "Fertilizer_Type", "Pesticide_Type",
        "Actual_Yield", "Weather_Temperature", "Weather_Rainfall",
    ],
    "sustainability": [
        "Farm_ID", "Crop_ID", "Carbon_Footprint", "Water_Footprint", "Sustainability_Score", "Fertilizer_Type",
        "Fertilizer_Amount", "Pesticide_Type", "Pesticide_Amount", "Transportation_Distance",
    ],
}

# Keys and measures of the roll-ups.
ROLLUPS = {
    "farm_analysis": (["Farm_ID", "Farm_Type"], ["Farm_Size_Acres", "Soil_Moisture", "Soil_Temperature"]),
    "crop_analysis": (["Crop_Type", "Crop_Variety"], ["Expected_Yield", "Actual_Yield", "Growing_Period_Days"]),
}

# Columns of the analytical tables.
CONTRACTS = {
    "farm_analysis": ["Farm_ID", "Farm_Type", "avg_Farm_Size_Acres", "avg_Soil_Moisture", "avg_Soil_Temperature"],
    "crop_analysis": [
        "Crop_Type", "Crop_Variety", "avg_Expected_Yield", "avg_Actual_Yield", "avg_Growing_Period_Days",
    ],
    "full_data": [
        "Farm_ID", "Farm_Type", "Farm_Size_Acres", "Crop_ID", "Planting_Date", "Harvest_Date", "Expected_Yield",
        "Actual_Yield", "Soil_Moisture", "Soil_Temperature", "Sustainability_Score", "year", "month",
        "Farm_Location", "Farmer_Contact", "Yield_Unit", "Soil_pH", "Soil_Fertility", "Weather_Sunlight",
        "Irrigation_Amount", "Fertilizer_Amount", "Pesticide_Type", "Pesticide_Amount", "Equipment_Used",
        "Labor_Hours", "Total_Revenue", "Quality_Grade", "Certification", "Carbon_Footprint", "Water_Footprint",
        "timestamp", "created_at",
    ],
}

# Columns of the marts.
MARTS = {
    "farm_performance": [
        "farm_id", "farm_name", "farm_location", "farm_type", "avg_farm_size_acres", "avg_soil_moisture",
        "avg_soil_temperature", "avg_soil_ph", "avg_organic_matter", "avg_water_usage", "avg_carbon_footprint",
        "avg_pesticide_usage", "avg_yield_per_hectare", "avg_actual_yield", "avg_expected_yield",
        "total_actual_yield", "avg_yield_percentage", "avg_sustainability_score", "recent_avg_yield",
        "avg_growing_period", "yield_per_acre", "farm_performance_score", "yield_rank", "sustainability_rank",
        "yield_rank_in_type", "generated_at",
    ],
    "crop_performance": [
        "crop_type", "crop_variety", "crop_name", "growing_season", "water_needs", "avg_expected_yield",
        "avg_actual_yield", "avg_growing_period_days", "yield_efficiency_pct", "avg_yield_per_hectare",
        "avg_quantity_produced", "avg_production_cost", "production_efficiency", "avg_harvest_yield", "farm_count",
        "avg_sustainability_score", "current_year_yield", "previous_year_yield", "yoy_growth_pct", "spring_yield",
        "summer_yield", "fall_yield", "winter_yield", "avg_yield_percentage", "crop_performance_score",
        "yield_efficiency_rank", "generated_at",
    ],
    "sustainability_metrics": [
        "farm_id", "farm_name", "farm_location", "farm_type", "crop_id", "crop_name", "crop_type", "water_needs",
        "year", "month", "planting_month", "sustainability_score", "water_usage", "carbon_footprint",
        "pesticide_usage", "ph_level", "organic_matter", "avg_precipitation", "avg_humidity",
        "comprehensive_sustainability_score", "sustainability_tier", "avg_soil_moisture", "avg_soil_temperature",
        "farm_size_acres", "water_need_rating", "water_efficiency", "carbon_efficiency", "resource_efficiency",
        "yield_density", "growing_period", "size_normalized_score", "yield_normalized_score", "generated_at",
    ],
    "seasonal_performance": [
        "farm_id", "farm_name", "farm_location", "crop_id", "crop_name", "crop_type", "year", "season", "avg_yield",
        "avg_expected_yield", "avg_yield_percentage", "avg_sustainability_score", "avg_growing_period",
        "yield_change_from_previous_year", "avg_temperature", "avg_precipitation", "avg_humidity",
        "season_recommendations", "season_performance_rating", "generated_at",
    ],
}

# Columns and types of the seed tables.
SEEDS_DDL = {
    "seed_farm": "farm_id long, farm_name string, farm_location string, farm_size long, established_date date",
    "seed_crop": "crop_id long, crop_name string, crop_type string, growing_season string, water_needs string",
    "seed_harvest": "harvest_id long, farm_id long, crop_id long, harvest_date date, yield_amount long, "
    "quality_grade string",
    "seed_production": "production_id long, farm_id long, crop_id long, date date, quantity_produced long, cost long",
    "seed_soil": "soil_id long, farm_id long, ph_level double, nutrient_content string, texture string, "
    "organic_matter double",
    "seed_sustainability": "sustainability_id long, farm_id long, date date, water_usage long, "
    "carbon_footprint long, pesticide_usage long",
    "seed_weather": "weather_id long, date date, location string, temperature long, precipitation long, humidity long",
    "seed_yield": "yield_id long, farm_id long, crop_id long, harvest_id long, yield_per_hectare double, year long",
}

# Accepted values and scales of the data dictionary.
ACCEPTED_VALUES = {
    "Farm_Type": ["Crop", "Livestock", "Mixed", "Horticulture"],
    "Crop_Type": ["Grain", "Vegetable", "Fruit", "Fiber", "Oilseed"],
    "Yield_Unit": ["kg", "ton", "bushel"],
    "Soil_Type": ["Clay", "Sandy", "Loam", "Silt", "Peaty"],
    "Irrigation_Method": ["Drip", "Sprinkler", "Flood", "None"],
    "Fertilizer_Type": ["Organic", "Chemical", "Mixed", "None"],
    "Pesticide_Type": ["Herbicide", "Insecticide", "Fungicide", "None"],
    "Equipment_Used": ["Tractor", "Harvester", "Drone", "Manual"],
    "Storage_Method": ["Silo", "Warehouse", "Cold Storage", "None"],
    "Transportation_Method": ["Truck", "Train", "Ship", "Air"],
    "Quality_Grade": ["Premium", "Standard", "Basic"],
    "Certification": ["Organic", "Fair Trade", "GAP", "None"],
    "Market_Destination": ["Local", "Regional", "National", "International"],
    "Customer_Segment": ["Retailer", "Processor", "Wholesaler", "Direct Consumer"],
    "Order_Status": ["Pending", "Processing", "Shipped", "Delivered", "Cancelled"],
    "Payment_Method": ["Cash", "Credit", "Bank Transfer", "Digital Wallet"],
    "Payment_Status": ["Pending", "Completed", "Failed", "Refunded"],
}
SCALES = {"Soil_Fertility": (1, 10), "Sustainability_Score": (1, 10)}


def dictionary_checks(columns: Collection[str]) -> list[Accepted | InRange]:
    """The data dictionary's checks for those of its fields that a table has."""
    accepted = [Accepted(name, values) for name, values in ACCEPTED_VALUES.items() if name in columns]
    return accepted + [InRange(name, low, high) for name, (low, high) in SCALES.items() if name in columns]


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def record_schema() -> T.StructType:
    return schema(RECORD_DDL)


def stream_schema() -> T.StructType:
    """Schema of a streamed message: the batch record under its streamed names, and the extra columns."""
    streamed = {batch: stream for stream, batch in STREAM_NAMES.items()}
    renamed = [
        T.StructField(streamed.get(f.name, f.name), f.dataType, True) for f in record_schema().fields
    ]
    return T.StructType([*renamed, *schema(STREAM_ONLY_DDL).fields])


def seed_schema(name: str) -> T.StructType:
    return schema(SEEDS_DDL[name])
