"""Row-level expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.bindings.testdata import Binding
from martflow.functions import scalar
from martflow.plans import marts, seeded
from martflow.workload.ansi import days, month, season, sql, year
from martflow.workload.registry import query

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    "value_map",
    sql(
        """SELECT crop_id, growing_season, water_needs,
        CASE growing_season WHEN 'Annual' THEN 365 WHEN 'Spring' THEN 90 WHEN 'Summer' THEN 100
          WHEN 'Fall' THEN 80 WHEN 'Winter' THEN 120 ELSE 90 END AS season_days,
        CASE water_needs WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Very High' THEN 4
          ELSE 0 END AS need_rating FROM crops"""
    ),
)
def value_map(b: Binding) -> DataFrame:
    return b.crops.select(
        "crop_id", "growing_season", "water_needs",
        seeded.growing_days("growing_season").alias("season_days"),
        scalar.value_map("water_needs", marts.WATER_NEED_RATING, marts.WATER_NEED_OTHERWISE).alias("need_rating"),
    )


@query(
    "band_tier",
    f"""SELECT {LINE_SQL},
        CASE WHEN l_tax * 1000 >= 80 THEN 5 WHEN l_tax * 1000 >= 60 THEN 4 WHEN l_tax * 1000 >= 40 THEN 3
          WHEN l_tax * 1000 >= 20 THEN 2 ELSE 1 END AS tier,
        CASE WHEN l_quantity * 2 > 80 THEN 'A' WHEN l_quantity * 2 > 60 THEN 'B' WHEN l_quantity * 2 > 40 THEN 'C'
          ELSE 'D' END AS grade
        FROM lineitem""",
)
def band_tier(b: Binding) -> DataFrame:
    return b.table("lineitem").select(
        *LINE,
        scalar.band(F.col("l_tax") * 1000, *marts.SUSTAINABILITY_TIERS, inclusive=True).alias("tier"),
        scalar.band(F.col("l_quantity") * 2, *seeded.GRADE).alias("grade"),
    )


@query(
    "rule_text",
    f"""SELECT {LINE_SQL}, {season('MONTH(l_shipdate)')} AS season,
        CASE WHEN l_quantity * 2 < 80 AND MONTH(l_shipdate) BETWEEN 6 AND 8
          THEN 'Consider additional irrigation or heat-resistant varieties'
          WHEN l_quantity * 2 < 80 AND MONTH(l_shipdate) IN (12, 1, 2)
          THEN 'Consider cold protection measures or winter-hardy varieties'
          WHEN l_quantity * 2 < 80 THEN 'Review growing conditions and varieties'
          ELSE 'Current practices are effective' END AS advice
        FROM lineitem""",
)
def rule_text(b: Binding) -> DataFrame:
    seasons = b.table("lineitem").withColumn("season", scalar.season_of(F.month("l_shipdate")))
    return seasons.select(*LINE, "season", marts.season_advice(F.col("l_quantity") * 2, "season").alias("advice"))


@query(
    "coalesce_defaults",
    sql(
        """SELECT f.farm_id, COALESCE(ph_level * 10, 60) AS soil_moisture,
        COALESCE(ph_level * 5 + 40, 55) AS soil_temperature, COALESCE(ph_level, 6.5) AS soil_ph
        FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id"""
    ),
)
def coalesce_defaults(b: Binding) -> DataFrame:
    joined = b.farms.join(b.soil, "farm_id", "left")
    return joined.select(
        "farm_id",
        seeded.soil_moisture("ph_level").alias("soil_moisture"),
        seeded.soil_temperature("ph_level").alias("soil_temperature"),
        scalar.or_default("ph_level", seeded.NO_SOIL["ph"]).alias("soil_ph"),
    )


@query(
    "safe_ratio",
    f"""SELECT {LINE_SQL}, l_quantity / NULLIF(l_tax, 0) AS per_tax,
        l_quantity * (1 - l_discount) / NULLIF(l_quantity, 0) * 100 AS pct FROM lineitem""",
)
def safe_ratio(b: Binding) -> DataFrame:
    return b.table("lineitem").select(
        *LINE,
        scalar.safe_ratio("l_quantity", "l_tax").alias("per_tax"),
        scalar.percent_of(F.col("l_quantity") * (1 - F.col("l_discount")), "l_quantity").alias("pct"),
    )


@query(
    "sqrt_norm",
    """SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 100 / SQRT(s_acctbal) END AS size_normalized FROM supplier""",
)
def sqrt_norm(b: Binding) -> DataFrame:
    return b.table("supplier").select(
        "s_suppkey", scalar.per_root(F.lit(100), "s_acctbal").alias("size_normalized")
    )


@query(
    "weighted_score",
    sql(
        """SELECT farm_id, COALESCE(carbon_footprint, 0) * 0.4::DOUBLE + (100 - COALESCE(water_usage, 0)) * 0.2::DOUBLE
        + (100 - COALESCE(pesticide_usage, 0)) * 0.2::DOUBLE AS score FROM sustainability"""
    ),
)
def weighted_score(b: Binding) -> DataFrame:
    return b.sustainability.select(
        "farm_id",
        scalar.weighted_sum(
            [
                (scalar.or_default("carbon_footprint", 0), 0.4),
                (100 - scalar.or_default("water_usage", 0), 0.2),
                (100 - scalar.or_default("pesticide_usage", 0), 0.2),
            ]
        ).alias("score"),
    )


@query(
    "month_floor",
    "SELECT o_orderkey, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS order_month FROM orders",
)
def month_floor(b: Binding) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return b.table("orders").select("o_orderkey", scalar.month_floor(day).alias("order_month"))


@query("growth_days", sql("SELECT farm_id, crop_id, planting_date, harvest_date, growing_period_days FROM records"))
def growth_days(b: Binding) -> DataFrame:
    return b.records.select("farm_id", "crop_id", "planting_date", "harvest_date", "growing_period_days")


@query("season_dates", sql("SELECT farm_id, crop_id, year, planting_date, harvest_date FROM season_dates"))
def season_dates(b: Binding) -> DataFrame:
    return seeded.season_dates(b.yields, b.crops)


@query(
    "season_of_month",
    f"""SELECT {season('MONTH(o_orderdate)')} AS season, COUNT(*) AS n_orders FROM orders GROUP BY 1""",
)
def season_of_month(b: Binding) -> DataFrame:
    season = scalar.season_of(F.month("o_orderdate")).alias("season")
    return b.table("orders").groupBy(season).agg(F.count(F.lit(1)).alias("n_orders"))


@query(
    "profit_margin",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(ROUND(CAST((l_extendedprice - p_retailprice)
        / NULLIF(l_extendedprice, 0) * 100 AS DECIMAL(28,10)), 2) AS DOUBLE) AS margin
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def profit_margin(b: Binding) -> DataFrame:
    joined = b.table("lineitem").join(b.table("part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(*LINE, scalar.profit_margin("l_extendedprice", "p_retailprice").alias("margin"))


def noise_step(state: str, key: str) -> str:
    return f"((({state} + {key} % 2147483647) % 2147483647) * 48271 + 12345) % 2147483647"


NOISE_SQL = f"(({noise_step('(' + noise_step('12345', 'farm_id') + ')', 'crop_id')}) / 2147483647.0::DOUBLE)"


@query("noise_deterministic", sql(f"SELECT farm_id, crop_id, {NOISE_SQL} AS noise FROM harvest"))
def noise_deterministic(b: Binding) -> DataFrame:
    return b.harvest.select("farm_id", "crop_id", scalar.stable_noise("farm_id", "crop_id").alias("noise"))


@query(
    "location_text",
    """SELECT c_custkey, PRINTF('%.4f,%.4f', c_nationkey + 0.5::DOUBLE, c_nationkey - 60.25::DOUBLE) AS location,
        c_nationkey + 0.5::DOUBLE AS lat, c_nationkey - 60.25::DOUBLE AS lon FROM customer""",
)
def location_text(b: Binding) -> DataFrame:
    located = b.table("customer").withColumn(
        "location", scalar.lat_lon_text(F.col("c_nationkey") + F.lit(0.5), F.col("c_nationkey") - F.lit(60.25))
    )
    return located.select(
        "c_custkey", "location", scalar.lat_of("location").alias("lat"), scalar.lon_of("location").alias("lon")
    )


@query(
    "shifted_dates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        STRFTIME(CAST(l_shipdate AS DATE) + CAST(l_linenumber AS INTEGER), '%Y-%m-%d') AS due FROM lineitem""",
)
def shifted_dates(b: Binding) -> DataFrame:
    shipped = F.col("l_shipdate").cast("date")
    return b.table("lineitem").select(*LINE, scalar.shifted_date_text(shipped, "l_linenumber").alias("due"))


@query(
    "content_ids",
    """SELECT o_orderkey, SHA256('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}')
        AS content_id FROM orders""",
)
def content_ids(b: Binding) -> DataFrame:
    return b.table("orders").select(
        "o_orderkey", scalar.content_id("o_orderkey", "o_orderstatus").alias("content_id")
    )


@query(
    "classified",
    sql(
        """SELECT "Irrigation_Method", "Soil_Type", CASE "Irrigation_Method" WHEN 'Drip' THEN 'High'
        WHEN 'Flood' THEN 'Low' WHEN 'None' THEN 'None' END AS efficiency,
        CASE WHEN "Soil_Type" = 'Clay' THEN "Soil_pH" BETWEEN 5.0 AND 7.5 ELSE "Soil_pH" BETWEEN 6.0 AND 7.0 END
        AS plausible, COUNT(*) AS n_records FROM raw GROUP BY ALL"""
    ),
)
def classified(b: Binding) -> DataFrame:
    return b.raw.groupBy(
        "Irrigation_Method", "Soil_Type",
        scalar.irrigation_efficiency("Irrigation_Method").alias("efficiency"),
        scalar.ph_plausible("Soil_Type", "Soil_pH").alias("plausible"),
    ).agg(F.count(F.lit(1)).alias("n_records"))


@query(
    "conform_dates",
    sql(
        f"""SELECT "Farm_ID", "Crop_ID", CAST("Planting_Date" AS DATE) AS date, {year('CAST("Planting_Date" AS DATE)')}
        AS year, {month('CAST("Planting_Date" AS DATE)')} AS month,
        CAST(DAY(CAST("Planting_Date" AS DATE)) AS INTEGER) AS day, {days('CAST("Planting_Date" AS DATE)',
        'CAST("Harvest_Date" AS DATE)')} AS growth FROM raw"""
    ),
)
def conform_dates(b: Binding) -> DataFrame:
    from martflow.operators.conform import add_date_parts
    from martflow.plans.star import conformed

    dated = add_date_parts(conformed(b.raw), "Planting_Date")
    return dated.select(
        "Farm_ID", "Crop_ID", "date", "year", "month", "day",
        scalar.days_between("Planting_Date", "Harvest_Date").alias("growth"),
    )
