"""The operators' tables, expressed over an order-processing star schema.

Suppliers stand for farms, parts for crops and order lines for records.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions import scalar
from martflow.functions.aggregate import total
from martflow.operators.joins import dealt_once, is_even, sent_whole
from martflow.workspace import materialise

SEASON_BY_SIZE = {0: "Spring", 1: "Summer", 2: "Winter", 3: "Annual"}
SEASON_OTHERWISE = "Fall"
NEED_BY_SIZE = ([(40, "Very High"), (25, "High"), (10, "Medium")], "Low")
FARM_KINDS = {0: "Crop", 1: "Livestock", 2: "Mixed"}
FARM_KIND_OTHERWISE = "Horticulture"
HARVEST_KEY_FACTOR = 10_000_000_000
# Decimals of the quantities, prices and shares of a single line.
MEASURE = 2


class Binding:
    """Lazy DataFrames over the tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.directory}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def farms(self) -> DataFrame:
        named = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        return named.select(
            F.col("s_suppkey").alias("farm_id"),
            F.col("s_name").alias("farm_name"),
            F.col("n_name").alias("farm_location"),
            F.col("s_acctbal").alias("farm_size"),
            F.make_date((F.lit(1980) + F.col("s_nationkey")).cast("int"), F.lit(3), F.lit(15)).alias(
                "established_date"
            ),
        )

    @cached_property
    def crops(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("crop_id"),
            F.col("p_name").alias("crop_name"),
            F.col("p_type").alias("crop_type"),
            F.col("p_brand").alias("crop_variety"),
            scalar.value_map(F.pmod("p_size", F.lit(5)), SEASON_BY_SIZE, SEASON_OTHERWISE).alias("growing_season"),
            scalar.band("p_size", *NEED_BY_SIZE).alias("water_needs"),
        )

    def _per_farm_and_crop(self, lines: DataFrame) -> DataFrame:
        return (
            lines.groupBy(F.col("l_suppkey").alias("farm_id"), F.col("l_partkey").alias("crop_id"))
            .agg(
                total("l_quantity", MEASURE).alias("quantity"),
                total("l_extendedprice", MEASURE).alias("price"),
                F.count(F.lit(1)).alias("n_lines"),
                F.year(F.max("l_shipdate")).alias("year"),
            )
        )

    def _with_harvest(self, kept: DataFrame) -> DataFrame:
        return kept.withColumn("harvest_id", F.col("farm_id") * HARVEST_KEY_FACTOR + F.col("crop_id"))

    @cached_property
    def _farm_crop(self) -> DataFrame:
        """Order lines per farm and crop, from which harvests, productions and yields are read."""
        return self._with_harvest(self._per_farm_and_crop(self.table("lineitem")))

    def shared(self) -> Binding:
        """Keep the order lines per farm and crop for a query that reads them several times.

        They are kept crop by crop, so that sums per crop are nearly done before they are shuffled.
        """
        lines = self.table("lineitem").select("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
        kept = self._per_farm_and_crop(dealt_once(lines, "l_partkey")).sortWithinPartitions("crop_id", "farm_id")
        self._farm_crop = self._with_harvest(materialise(kept, "farm-crop"))
        return self

    @cached_property
    def harvest(self) -> DataFrame:
        return self._farm_crop.select("harvest_id", "farm_id", "crop_id", F.col("quantity").alias("yield_amount"))

    @cached_property
    def production(self) -> DataFrame:
        return self._farm_crop.select(
            F.col("harvest_id").alias("production_id"), "farm_id", "crop_id",
            F.col("quantity").alias("quantity_produced"), F.col("price").alias("cost"),
        )

    @cached_property
    def yields(self) -> DataFrame:
        return self._farm_crop.select(
            F.col("harvest_id").alias("yield_id"), "farm_id", "crop_id", "harvest_id",
            (F.col("quantity") / 4).alias("yield_per_hectare"), "year",
        )

    @cached_property
    def soil(self) -> DataFrame:
        """Soil of the farms that are not in debt."""
        return self.table("supplier").where("s_acctbal >= 0").select(
            F.col("s_suppkey").alias("soil_id"),
            F.col("s_suppkey").alias("farm_id"),
            (F.lit(5.0) + F.col("s_nationkey") / 10).alias("ph_level"),
            (F.col("s_nationkey") / 8).alias("organic_matter"),
        )

    @cached_property
    def sustainability(self) -> DataFrame:
        """Resource use of a farm: its nation's customers, in total, solvent, and of one segment."""
        per_nation = self.table("customer").groupBy("c_nationkey").agg(
            F.count_if(F.col("c_acctbal") > 0).alias("water_usage"),
            F.count(F.lit(1)).alias("carbon_footprint"),
            F.count_if(F.col("c_mktsegment") == "BUILDING").alias("pesticide_usage"),
        )
        joined = self.table("supplier").join(per_nation, F.col("s_nationkey") == F.col("c_nationkey"))
        return joined.select(
            F.col("s_suppkey").alias("sustainability_id"),
            F.col("s_suppkey").alias("farm_id"),
            "water_usage", "carbon_footprint", "pesticide_usage",
        )

    @cached_property
    def weather(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("weather_id"),
            (F.col("r_regionkey") * 5 + 10).alias("temperature"),
            (F.col("r_regionkey") * 3).alias("precipitation"),
            (F.col("r_regionkey") + 40).alias("humidity"),
        )

    @property
    def seeds(self) -> dict[str, DataFrame]:
        return {
            "farm": self.farms, "crop": self.crops, "harvest": self.harvest, "yield": self.yields,
            "production": self.production, "soil": self.soil, "sustainability": self.sustainability,
            "weather": self.weather,
        }

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with their order, part and supplier."""
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(sent_whole(self.table("supplier")), F.col("l_suppkey") == F.col("s_suppkey"))
        )

    @cached_property
    def records(self) -> DataFrame:
        """Order lines in the staged full_data shape; crop ids are texts, as they are there."""
        planting, harvest = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
        actual = F.col("l_quantity") * (1 - F.col("l_discount"))
        return self.lines.select(
            F.col("l_suppkey").alias("farm_id"),
            F.col("l_partkey").cast("string").alias("crop_id"),
            F.col("p_type").alias("crop_type"),
            F.col("s_acctbal").alias("farm_size_acres"),
            planting.alias("planting_date"),
            harvest.alias("harvest_date"),
            F.col("l_quantity").alias("expected_yield"),
            actual.alias("actual_yield"),
            (F.col("l_discount") * 100).alias("soil_moisture"),
            (F.col("l_tax") * 100).alias("soil_temperature"),
            (F.col("l_tax") * 1000).alias("sustainability_score"),
            F.year(planting).alias("year"),
            F.month(planting).alias("month"),
            scalar.month_floor(planting).alias("planting_month"),
            scalar.days_between(planting, harvest).alias("growing_period_days"),
            scalar.percent_of(actual, "l_quantity").alias("yield_percentage"),
        )

    @staticmethod
    def _crop(key: str) -> Column:
        return F.concat(F.lit("CROP_"), F.col(key).cast("string"))

    @cached_property
    def raw(self) -> DataFrame:
        """Order lines as flat farm records, under record names, with dates and ids as texts."""
        return self._raw(self.lines, self._crop("l_partkey"))

    def stored_raw(self) -> DataFrame:
        """The flat farm records, stored for a query that reads them several times.

        Where no crop is hot they are stored in buckets of crops: the lines are dealt by crop ahead of the join to the parts,
        while they are narrow, and nothing that holds the crop is shuffled for it again. Sorted by farm, of which a bucket
        has far more than crops, they take less room.
        """
        if not is_even(self.table("lineitem"), "l_partkey"):
            return materialise(self.raw, "raw")

        def dated(name: str, day: str) -> DataFrame:
            return self.table(name).withColumn(day, F.col(day).cast("date"))

        ordered = (
            dated("lineitem", "l_shipdate")
            .join(dated("orders", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("crop", self._crop("l_partkey"))
            .drop("l_partkey")
        )
        lines = (
            ordered.repartition("crop")
            .join(self.table("part").withColumn("crop", self._crop("p_partkey")), "crop")
            .join(sent_whole(self.table("supplier")), F.col("l_suppkey") == F.col("s_suppkey"))
        )
        return materialise(self._raw(lines, F.col("crop")), "raw", by="Crop_ID", sort_by=["Farm_ID"])

    def _raw(self, lines: DataFrame, crop: Column) -> DataFrame:
        def day(column: str):
            return F.date_format(F.col(column).cast("date"), "yyyy-MM-dd")

        returned = scalar.value_map("l_returnflag", {"A": "Drip", "N": "Sprinkler", "R": "Flood"}, "None")
        status = F.col("l_linestatus")
        actual = F.col("l_quantity") * (1 - F.col("l_discount"))
        return lines.select(
            F.concat(F.lit("FARM_"), F.col("l_suppkey").cast("string")).alias("Farm_ID"),
            scalar.value_map(F.pmod("s_nationkey", F.lit(4)), FARM_KINDS, FARM_KIND_OTHERWISE).alias("Farm_Type"),
            F.col("s_acctbal").alias("Farm_Size_Acres"),
            F.concat_ws(",", F.col("s_nationkey").cast("string"), F.col("l_suppkey").cast("string")).alias(
                "Farm_Location"
            ),
            F.col("l_suppkey").cast("string").alias("Farmer_ID"),
            F.col("s_name").alias("Farmer_Name"),
            F.concat(F.col("s_name"), F.lit("@farm")).alias("Farmer_Contact"),
            crop.alias("Crop_ID"),
            F.col("p_type").alias("Crop_Type"),
            F.col("p_brand").alias("Crop_Variety"),
            day("o_orderdate").alias("Planting_Date"),
            day("l_shipdate").alias("Harvest_Date"),
            F.col("l_quantity").alias("Expected_Yield"),
            actual.alias("Actual_Yield"),
            F.lit("kg").alias("Yield_Unit"),
            F.when(status == "F", "Clay").otherwise("Loam").alias("Soil_Type"),
            (F.col("l_discount") * 10 + 5).alias("Soil_pH"),
            (F.col("l_discount") * 100).alias("Soil_Moisture"),
            (F.col("l_tax") * 100).alias("Soil_Temperature"),
            F.col("l_linenumber").alias("Soil_Fertility"),
            (F.col("l_tax") * 200).alias("Weather_Temperature"),
            (F.col("l_discount") * 500).alias("Weather_Humidity"),
            F.col("l_quantity").alias("Weather_Rainfall"),
            F.col("l_linenumber").cast("double").alias("Weather_Sunlight"),
            returned.alias("Irrigation_Method"),
            F.col("l_quantity").alias("Irrigation_Amount"),
            F.when(status == "F", "Organic").otherwise("Chemical").alias("Fertilizer_Type"),
            (F.col("l_tax") * 100).alias("Fertilizer_Amount"),
            F.when(status == "F", "None").otherwise("Herbicide").alias("Pesticide_Type"),
            (F.col("l_discount") * 100).alias("Pesticide_Amount"),
            F.col("p_size").alias("Transportation_Distance"),
            (F.col("l_extendedprice") * 0.5).alias("Production_Cost"),
            F.col("p_retailprice").alias("Market_Price"),
            F.col("l_extendedprice").alias("Total_Revenue"),
            (F.col("l_discount") * 100).alias("Profit_Margin"),
            F.when(F.col("l_tax") > 0.04, "Organic").otherwise("None").alias("Certification"),
            F.col("l_quantity").alias("Carbon_Footprint"),
            (F.col("l_quantity") * 2).alias("Water_Footprint"),
            F.col("l_linenumber").alias("Sustainability_Score"),
            day("o_orderdate").alias("Order_Date"),
            day("l_shipdate").alias("Delivery_Date"),
            F.col("o_orderstatus").alias("Order_Status"),
            scalar.days_between(F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")).alias(
                "Growing_Period_Days"
            ),
        )


Query = Callable[[SparkSession, str], DataFrame]
