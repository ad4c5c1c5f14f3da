"""SQL building blocks: the same tables as ``bindings.testdata``, for an engine that reads the files directly."""

from __future__ import annotations


def total(value: str, scale: int = 4) -> str:
    """Sum at a number of decimals; beyond five of them as two integer sums."""
    if scale <= 5:
        return f"CAST(SUM(CAST({value} AS DECIMAL(18,{scale}))) AS DOUBLE)"
    scaled, finer = f"(({value}) * 100000::DOUBLE)", 10 ** (scale - 5)
    return (
        f"(CAST(SUM(CAST(FLOOR({scaled}) AS HUGEINT)) * {finer} + "
        f"SUM(CAST(ROUND_EVEN(({scaled} - FLOOR({scaled})) * {finer}::DOUBLE, 0) AS HUGEINT)) AS DOUBLE) "
        f"/ {10**scale}::DOUBLE)"
    )


def mean(value: str, scale: int = 4) -> str:
    return f"({total(value, scale)} / NULLIF(COUNT({value}), 0))"


def days(start: str, end: str) -> str:
    return f"CAST(DATE_DIFF('day', {start}, {end}) AS INTEGER)"


def year(value: str) -> str:
    return f"CAST(YEAR({value}) AS INTEGER)"


def month(value: str) -> str:
    return f"CAST(MONTH({value}) AS INTEGER)"


def season(value: str) -> str:
    return (
        f"CASE WHEN {value} BETWEEN 3 AND 5 THEN 'Spring' WHEN {value} BETWEEN 6 AND 8 THEN 'Summer' "
        f"WHEN {value} BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END"
    )


TABLES = f"""WITH farms AS (
  SELECT s_suppkey AS farm_id, s_name AS farm_name, n_name AS farm_location, s_acctbal AS farm_size,
         MAKE_DATE(1980 + s_nationkey, 3, 15) AS established_date
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
), crops AS (
  SELECT p_partkey AS crop_id, p_name AS crop_name, p_type AS crop_type, p_brand AS crop_variety,
         CASE p_size % 5 WHEN 0 THEN 'Spring' WHEN 1 THEN 'Summer' WHEN 2 THEN 'Winter' WHEN 3 THEN 'Annual'
              ELSE 'Fall' END AS growing_season,
         CASE WHEN p_size > 40 THEN 'Very High' WHEN p_size > 25 THEN 'High' WHEN p_size > 10 THEN 'Medium'
              ELSE 'Low' END AS water_needs
  FROM part
), farm_crop AS (
  SELECT l_suppkey AS farm_id, l_partkey AS crop_id, {total('l_quantity', 2)} AS quantity,
         {total('l_extendedprice', 2)} AS price, {year('MAX(l_shipdate)')} AS year,
         l_suppkey * 10000000000 + l_partkey AS harvest_id
  FROM lineitem GROUP BY l_suppkey, l_partkey
), harvest AS (
  SELECT harvest_id, farm_id, crop_id, quantity AS yield_amount FROM farm_crop
), production AS (
  SELECT harvest_id AS production_id, farm_id, crop_id, quantity AS quantity_produced, price AS cost FROM farm_crop
), yields AS (
  SELECT harvest_id AS yield_id, farm_id, crop_id, harvest_id, quantity / 4 AS yield_per_hectare, year FROM farm_crop
), soil AS (
  SELECT s_suppkey AS soil_id, s_suppkey AS farm_id, 5.0::DOUBLE + s_nationkey::DOUBLE / 10 AS ph_level,
         s_nationkey::DOUBLE / 8 AS organic_matter
  FROM supplier WHERE s_acctbal >= 0
), per_nation AS (
  SELECT c_nationkey, COUNT(*) FILTER (WHERE c_acctbal > 0) AS water_usage, COUNT(*) AS carbon_footprint,
         COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS pesticide_usage
  FROM customer GROUP BY c_nationkey
), sustainability AS (
  SELECT s_suppkey AS sustainability_id, s_suppkey AS farm_id, water_usage, carbon_footprint, pesticide_usage
  FROM supplier JOIN per_nation ON s_nationkey = c_nationkey
), weather AS (
  SELECT r_regionkey AS weather_id, r_regionkey * 5 + 10 AS temperature, r_regionkey * 3 AS precipitation,
         r_regionkey + 40 AS humidity
  FROM region
), lines AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
), records AS (
  SELECT l_suppkey AS farm_id, CAST(l_partkey AS VARCHAR) AS crop_id, p_type AS crop_type,
         s_acctbal AS farm_size_acres, CAST(o_orderdate AS DATE) AS planting_date,
         CAST(l_shipdate AS DATE) AS harvest_date, l_quantity AS expected_yield,
         l_quantity * (1 - l_discount) AS actual_yield, l_discount * 100 AS soil_moisture,
         l_tax * 100 AS soil_temperature, l_tax * 1000 AS sustainability_score, {year('o_orderdate')} AS year,
         {month('o_orderdate')} AS month, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS planting_month,
         {days('CAST(o_orderdate AS DATE)', 'CAST(l_shipdate AS DATE)')} AS growing_period_days,
         l_quantity * (1 - l_discount) / NULLIF(l_quantity, 0) * 100 AS yield_percentage
  FROM lines
), raw AS (
  SELECT 'FARM_' || l_suppkey AS "Farm_ID",
         CASE s_nationkey % 4 WHEN 0 THEN 'Crop' WHEN 1 THEN 'Livestock' WHEN 2 THEN 'Mixed'
              ELSE 'Horticulture' END AS "Farm_Type",
         s_acctbal AS "Farm_Size_Acres", s_nationkey || ',' || l_suppkey AS "Farm_Location",
         CAST(l_suppkey AS VARCHAR) AS "Farmer_ID", s_name AS "Farmer_Name", s_name || '@farm' AS "Farmer_Contact",
         'CROP_' || l_partkey AS "Crop_ID", p_type AS "Crop_Type", p_brand AS "Crop_Variety",
         STRFTIME(o_orderdate, '%Y-%m-%d') AS "Planting_Date", STRFTIME(l_shipdate, '%Y-%m-%d') AS "Harvest_Date",
         l_quantity AS "Expected_Yield", l_quantity * (1 - l_discount) AS "Actual_Yield", 'kg' AS "Yield_Unit",
         CASE WHEN l_linestatus = 'F' THEN 'Clay' ELSE 'Loam' END AS "Soil_Type",
         l_discount * 10 + 5 AS "Soil_pH", l_discount * 100 AS "Soil_Moisture", l_tax * 100 AS "Soil_Temperature",
         l_linenumber AS "Soil_Fertility", l_tax * 200 AS "Weather_Temperature",
         l_discount * 500 AS "Weather_Humidity", l_quantity AS "Weather_Rainfall",
         CAST(l_linenumber AS DOUBLE) AS "Weather_Sunlight",
         CASE l_returnflag WHEN 'A' THEN 'Drip' WHEN 'N' THEN 'Sprinkler' WHEN 'R' THEN 'Flood'
              ELSE 'None' END AS "Irrigation_Method",
         l_quantity AS "Irrigation_Amount",
         CASE WHEN l_linestatus = 'F' THEN 'Organic' ELSE 'Chemical' END AS "Fertilizer_Type",
         l_tax * 100 AS "Fertilizer_Amount",
         CASE WHEN l_linestatus = 'F' THEN 'None' ELSE 'Herbicide' END AS "Pesticide_Type",
         l_discount * 100 AS "Pesticide_Amount", p_size AS "Transportation_Distance",
         l_extendedprice * 0.5 AS "Production_Cost", p_retailprice AS "Market_Price",
         l_extendedprice AS "Total_Revenue", l_discount * 100 AS "Profit_Margin",
         CASE WHEN l_tax > 0.04 THEN 'Organic' ELSE 'None' END AS "Certification",
         l_quantity AS "Carbon_Footprint", l_quantity * 2 AS "Water_Footprint",
         l_linenumber AS "Sustainability_Score", STRFTIME(o_orderdate, '%Y-%m-%d') AS "Order_Date",
         STRFTIME(l_shipdate, '%Y-%m-%d') AS "Delivery_Date", o_orderstatus AS "Order_Status",
         {days('CAST(o_orderdate AS DATE)', 'CAST(l_shipdate AS DATE)')} AS "Growing_Period_Days"
  FROM lines
), season_dates AS (
  SELECT y.farm_id, y.crop_id, y.year,
         CASE growing_season WHEN 'Spring' THEN MAKE_DATE(y.year, 3, 15) WHEN 'Summer' THEN MAKE_DATE(y.year, 6, 15)
              WHEN 'Winter' THEN MAKE_DATE(y.year, 11, 15) WHEN 'Annual' THEN MAKE_DATE(y.year, 4, 1)
              ELSE MAKE_DATE(y.year, 5, 1) END AS planting_date,
         CASE growing_season WHEN 'Spring' THEN MAKE_DATE(y.year, 6, 15) WHEN 'Summer' THEN MAKE_DATE(y.year, 9, 15)
              WHEN 'Winter' THEN MAKE_DATE(y.year, 2, 15) WHEN 'Annual' THEN MAKE_DATE(y.year, 10, 1)
              ELSE MAKE_DATE(y.year, 9, 1) END AS harvest_date
  FROM yields y JOIN crops c ON y.crop_id = c.crop_id
), seed_records AS (
  SELECT f.*, d.crop_id, d.planting_date, d.harvest_date, c.crop_name, c.crop_type, h.yield_amount,
         u.water_usage, u.carbon_footprint AS carbon, u.pesticide_usage, s.ph_level, s.organic_matter,
         COALESCE(100 - u.carbon_footprint, 75) AS score
  FROM farms f JOIN season_dates d ON f.farm_id = d.farm_id JOIN crops c ON d.crop_id = c.crop_id
  LEFT JOIN harvest h ON f.farm_id = h.farm_id AND c.crop_id = h.crop_id
  LEFT JOIN yields y ON h.harvest_id = y.harvest_id
  LEFT JOIN sustainability u ON f.farm_id = u.farm_id LEFT JOIN soil s ON f.farm_id = s.farm_id
)
"""


def sql(body: str, **ctes: str) -> str:
    """A statement over the tables above, with further named subqueries."""
    more = "".join(f", {name} AS ({text})\n" for name, text in ctes.items())
    return TABLES + more + body
