"""Dimensions, facts, roll-ups, staging views, seed-derived tables and marts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.bindings import agri
from martflow.bindings.testdata import MEASURE, Binding
from martflow.functions.aggregate import FixedPoint
from martflow.plans import marts, olap, refresh, seeded, staging, star
from martflow.sinks.committed import CommittedTable
from martflow.workload.ansi import days, mean, month, season, sql, total, year
from martflow.workload.registry import query
from martflow.workload.relational import AMOUNT, AS_OF_YEAR, RATIO, year_mean
from martflow.workload.scalars import NOISE_SQL
from martflow.workspace import materialise, new_path

AS_OF = datetime(2024, 1, 1)
TODAY = date(2024, 1, 1)
LOADED = "DATE '2024-01-01' AS loaded_at"
RECORDS = FixedPoint(MEASURE, RATIO, AMOUNT)
AUDIT = ["timestamp", "created_at", "loaded_at"]


def quoted(columns) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def register_star() -> None:
    for name, columns in agri.DIMENSIONS.items():
        query(f"dim_{name}", sql(f"SELECT DISTINCT {quoted(columns)} FROM raw"))(
            lambda b, name=name: star.dimension(star.conformed(b.raw), name)
        )
    for label, name in (("yield", "crop_yield"), ("sustainability", "sustainability")):
        query(f"fact_{label}", sql(f"SELECT {quoted(agri.FACTS[name])} FROM raw"))(
            lambda b, name=name: star.fact(star.conformed(b.raw), name)
        )


register_star()

PLANTED, HARVESTED = 'CAST("Planting_Date" AS DATE)', 'CAST("Harvest_Date" AS DATE)'


@query(
    "fact_production",
    sql(
        f"""SELECT "Farm_ID", "Crop_ID", {PLANTED} AS "Planting_Date", {HARVESTED} AS "Harvest_Date", "Actual_Yield",
        "Production_Cost", "Total_Revenue", {year(PLANTED)} AS "Planting_Year", {month(PLANTED)} AS "Planting_Month",
        {year(HARVESTED)} AS "Harvest_Year", {month(HARVESTED)} AS "Harvest_Month",
        {days(PLANTED, HARVESTED)} AS "Growth_Period_Days" FROM raw"""
    ),
)
def fact_production(b: Binding) -> DataFrame:
    return star.production_fact(star.conformed(b.raw))


@query(
    "dim_farm_latest",
    sql(
        f"""SELECT {quoted(agri.DIMENSIONS['farm'])} FROM raw QUALIFY ROW_NUMBER() OVER (PARTITION BY "Farm_ID"
        ORDER BY "Planting_Date" DESC, "Farm_Size_Acres" DESC) = 1"""
    ),
)
def dim_farm_latest(b: Binding) -> DataFrame:
    return star.dimension(star.conformed(b.raw), "farm", ["Farm_ID"], "Planting_Date")


@query(
    "full_data",
    sql(
        f"""SELECT "Farm_ID", "Crop_ID", "Actual_Yield", {PLANTED} AS date, {year(PLANTED)} AS year,
        {month(PLANTED)} AS month, CAST(DAY({PLANTED}) AS INTEGER) AS day FROM raw"""
    ),
)
def full_data(b: Binding) -> DataFrame:
    dated = olap.full_data(star.conformed(b.raw), "Planting_Date")
    return dated.select("Farm_ID", "Crop_ID", "Actual_Yield", "date", "year", "month", "day")


# Staging


def register_staging() -> None:
    sources = {
        "stg_crop": "crops", "stg_farm": "farms", "stg_harvest": "harvest", "stg_production": "production",
        "stg_soil": "soil", "stg_sustainability": "sustainability", "stg_weather": "weather", "stg_yield": "yields",
    }
    for view, source in sources.items():
        columns = ", ".join(staging.SEED_COLUMNS[view])
        query(view, sql(f"SELECT {columns}, {LOADED} FROM {source}"))(
            lambda b, view=view, source=source: staging.stage_seed(getattr(b, source), view, TODAY)
        )


register_staging()


@query(
    "stg_farm_analysis",
    sql(
        f"""SELECT "Farm_ID" AS farm_id, "Farm_Type" AS farm_type, {mean('"Farm_Size_Acres"')} AS avg_farm_size_acres,
        {mean('"Soil_Moisture"')} AS avg_soil_moisture, {mean('"Soil_Temperature"')} AS avg_soil_temperature, {LOADED}
        FROM raw GROUP BY ALL"""
    ),
)
def stg_farm_analysis(b: Binding) -> DataFrame:
    return staging.stage_farm_analysis(olap.farm_analysis(b.raw, MEASURE), TODAY)


@query(
    "stg_crop_analysis",
    sql(
        f"""SELECT "Crop_Type" AS crop_type, "Crop_Variety" AS crop_variety,
        {mean('"Expected_Yield"')} AS avg_expected_yield, {mean('"Actual_Yield"')} AS avg_actual_yield,
        {mean('"Growing_Period_Days"')} AS avg_growing_period_days, {LOADED} FROM raw GROUP BY ALL"""
    ),
)
def stg_crop_analysis(b: Binding) -> DataFrame:
    return staging.stage_crop_analysis(olap.crop_analysis(b.raw, MEASURE), TODAY)


@query(
    "stg_full_data",
    sql(
        f"""SELECT "Farm_ID" AS farm_id, "Crop_ID" AS crop_id, "Farm_Type" AS farm_type,
        "Farm_Size_Acres" AS farm_size_acres, {PLANTED} AS planting_date, {HARVESTED} AS harvest_date,
        "Expected_Yield" AS expected_yield, "Actual_Yield" AS actual_yield, "Soil_Moisture" AS soil_moisture,
        "Soil_Temperature" AS soil_temperature, "Sustainability_Score" AS sustainability_score,
        {year(PLANTED)} AS year, {month(PLANTED)} AS month,
        CAST(DATE_TRUNC('month', {PLANTED}) AS DATE) AS planting_month,
        {days(PLANTED, HARVESTED)} AS growing_period_days,
        "Actual_Yield" / NULLIF("Expected_Yield", 0) * 100 AS yield_percentage, {LOADED} FROM raw"""
    ),
)
def stg_full_data(b: Binding) -> DataFrame:
    dated = olap.full_data(star.conformed(b.raw), "Planting_Date")
    return staging.stage_full_data(dated, TODAY)


# Seed-derived tables


@query(
    "seed_farm_analysis",
    sql(
        """SELECT f.farm_id AS "Farm_ID", 'Mixed' AS "Farm_Type", farm_size AS "avg_Farm_Size_Acres",
        COALESCE(ph_level * 10, 60) AS "avg_Soil_Moisture", COALESCE(ph_level * 5 + 40, 55) AS "avg_Soil_Temperature"
        FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id"""
    ),
)
def seed_farm_analysis(b: Binding) -> DataFrame:
    return seeded.farm_analysis(b.farms, b.soil)


GROWING_DAYS = """CASE growing_season WHEN 'Annual' THEN 365 WHEN 'Spring' THEN 90 WHEN 'Summer' THEN 100
    WHEN 'Fall' THEN 80 WHEN 'Winter' THEN 120 ELSE 90 END AS "avg_Growing_Period_Days" """


@query(
    "seed_crop_const",
    sql(
        f"""SELECT crop_type AS "Crop_Type", crop_name AS "Crop_Variety", 100 AS "avg_Expected_Yield",
        90 AS "avg_Actual_Yield", {GROWING_DAYS} FROM crops"""
    ),
)
def seed_crop_const(b: Binding) -> DataFrame:
    return seeded.crop_analysis_constant(b.crops)


@query(
    "seed_crop_avg",
    sql(
        f"""SELECT crop_type AS "Crop_Type", crop_name AS "Crop_Variety", {mean('yield_amount')} AS "avg_Expected_Yield",
        {mean('yield_amount * 0.9::DOUBLE')} AS "avg_Actual_Yield", {GROWING_DAYS}
        FROM crops c LEFT JOIN harvest h ON c.crop_id = h.crop_id GROUP BY crop_type, crop_name, growing_season"""
    ),
)
def seed_crop_avg(b: Binding) -> DataFrame:
    return seeded.crop_analysis_from_harvest(b.crops, b.harvest, AMOUNT)


DERIVED = {
    "soil_moisture": "COALESCE(ph_level * 10, 60)",
    "soil_temperature": "COALESCE(ph_level * 5 + 40, 55)",
    "sustainability_score": "score",
    "year": year("planting_date"),
    "month": month("planting_date"),
    "yield_unit": "'kg/hectare'",
    "soil_ph": "COALESCE(ph_level, 6.5)",
    "soil_fertility": "CASE WHEN organic_matter > 3 THEN 'High' WHEN organic_matter > 1.5 THEN 'Medium' ELSE 'Low' END",
    "weather_sunlight": "8",
    "irrigation_amount": "COALESCE(water_usage * 10, 200)",
    "fertilizer_amount": "100",
    "pesticide_type": "CASE WHEN pesticide_usage > 50 THEN 'Chemical' ELSE 'Organic' END",
    "pesticide_amount": "COALESCE(pesticide_usage, 30)",
    "equipment_used": "CASE WHEN farm_size > 200 THEN 'Heavy Machinery' WHEN farm_size > 100 THEN 'Tractor' "
    "ELSE 'Manual Tools' END",
    "labor_hours": "farm_size * 2",
    "total_revenue": "yield_amount * 10",
    "quality_grade": "CASE WHEN score > 80 THEN 'A' WHEN score > 60 THEN 'B' WHEN score > 40 THEN 'C' ELSE 'D' END",
    "certification": "CASE WHEN score > 70 THEN 'Organic' ELSE 'Conventional' END",
    "carbon_footprint": "COALESCE(carbon, 50)",
    "water_footprint": "COALESCE(water_usage * 100, 300)",
}


@query(
    "seed_full_data",
    sql(
        """SELECT farm_id AS "Farm_ID", crop_type AS "Farm_Type", farm_size AS "Farm_Size_Acres",
        CAST(crop_id AS VARCHAR) AS "Crop_ID", planting_date AS "Planting_Date", harvest_date AS "Harvest_Date",
        yield_amount AS "Expected_Yield", yield_amount * 0.9::DOUBLE AS "Actual_Yield",
        farm_location AS "Farm_Location", farm_name AS "Farmer_Contact", """
        + ", ".join(f'{text} AS "{seeded.contract_name(name)}"' for name, text in DERIVED.items())
        + " FROM seed_records"
    ),
)
def seed_full_data(b: Binding) -> DataFrame:
    return seeded.full_data(b.shared().seeds, AS_OF).drop(*AUDIT)


VARIED = f"(yield_amount * (0.5::DOUBLE + {NOISE_SQL} * 0.7::DOUBLE))"
STAGED_FULL_DATA = (
    f"""SELECT farm_id, CAST(crop_id AS VARCHAR) AS crop_id, farm_name AS farmer_contact, farm_location,
    {year('established_date')} AS established_year, crop_type, crop_name, farm_size AS farm_size_acres, planting_date,
    harvest_date, yield_amount AS expected_yield, CASE WHEN yield_amount > 0 THEN {VARIED} ELSE 100 END AS actual_yield,
    {days('planting_date', 'harvest_date')} AS growing_period_days,
    {VARIED} / NULLIF(yield_amount, 0) * 100 AS yield_percentage, """
    + ", ".join(f"{text} AS {name}" for name, text in DERIVED.items())
    + " FROM seed_records"
)


@query("stg_full_data_synth", sql(STAGED_FULL_DATA))
def stg_full_data_synth(b: Binding) -> DataFrame:
    return seeded.staged_full_data(b.shared().seeds, AS_OF).drop(*AUDIT)


@query(
    "seed_fallback_rollups",
    sql(
        """SELECT CAST(farm_id AS VARCHAR) AS name, 'Mixed' AS kind, 60 AS a, 55 AS b FROM farms
        UNION ALL SELECT crop_name, crop_type, 100, 90 FROM crops"""
    ),
)
def seed_fallback_rollups(b: Binding) -> DataFrame:
    farm = seeded.fallback_farm_analysis(b.farms).select(
        F.col("Farm_ID").cast("string").alias("name"), F.col("Farm_Type").alias("kind"),
        F.col("avg_Soil_Moisture").alias("a"), F.col("avg_Soil_Temperature").alias("b"),
    )
    crop = seeded.fallback_crop_analysis(b.crops).select(
        F.col("Crop_Variety").alias("name"), F.col("Crop_Type").alias("kind"),
        F.col("avg_Expected_Yield").alias("a"), F.col("avg_Actual_Yield").alias("b"),
    )
    return farm.unionByName(crop)


# Marts


def farm_sides(source: str, scale: int) -> dict[str, str]:
    """The aggregates of the farm mart, records being summed at a number of decimals."""

    def of_record(value: str) -> str:
        return mean(value, scale)

    return {
        "by_type": f"""SELECT farm_id, crop_type AS farm_type, {of_record('soil_moisture')} AS avg_soil_moisture,
            {of_record('soil_temperature')} AS avg_soil_temperature, {of_record('actual_yield')} AS avg_actual_yield,
            {of_record('expected_yield')} AS avg_expected_yield, {total('actual_yield', scale)} AS plain_total,
            {of_record('yield_percentage')} AS avg_yield_percentage,
            {of_record('sustainability_score')} AS avg_sustainability_score,
            {of_record('CASE WHEN year >= 2000 THEN actual_yield END')} AS recent_avg_yield,
            {of_record('growing_period_days')} AS avg_growing_period,
            {mean('actual_yield / NULLIF(farm_size_acres, 0)', 10)} AS yield_per_acre
            FROM {source} GROUP BY farm_id, crop_type""",
        "soil_side": f"""SELECT farm_id, COUNT(*) AS k, {mean('ph_level')} AS avg_soil_ph,
            {mean('organic_matter')} AS avg_organic_matter FROM soil GROUP BY farm_id""",
        "use_side": f"""SELECT farm_id, COUNT(*) AS k, {mean('water_usage')} AS avg_water_usage,
            {mean('carbon_footprint')} AS avg_carbon_footprint, {mean('pesticide_usage')} AS avg_pesticide_usage,
            {mean('COALESCE(water_usage, 0)')} AS water, {mean('COALESCE(carbon_footprint, 0)')} AS carbon
            FROM sustainability GROUP BY farm_id""",
        "yield_side": f"""SELECT farm_id, COUNT(*) AS k, {mean('yield_per_hectare')} AS avg_yield_per_hectare
            FROM yields GROUP BY farm_id""",
        "metrics": """SELECT f.farm_id, farm_name, farm_location, farm_type, farm_size AS avg_farm_size_acres,
            avg_soil_moisture, avg_soil_temperature, avg_soil_ph, avg_organic_matter, avg_water_usage,
            avg_carbon_footprint, avg_pesticide_usage, avg_yield_per_hectare, avg_actual_yield, avg_expected_yield,
            plain_total * (COALESCE(s.k, 1) * COALESCE(u.k, 1) * COALESCE(y.k, 1))::DOUBLE AS total_actual_yield,
            avg_yield_percentage, avg_sustainability_score, recent_avg_yield, avg_growing_period, yield_per_acre,
            avg_yield_percentage * 0.4::DOUBLE + avg_sustainability_score * 0.3::DOUBLE
            + (100 - COALESCE(water, 0) * 0.1::DOUBLE) + (100 - COALESCE(carbon, 0) * 0.2::DOUBLE)
              AS farm_performance_score
            FROM farms f LEFT JOIN by_type t ON f.farm_id = t.farm_id LEFT JOIN soil_side s ON f.farm_id = s.farm_id
            LEFT JOIN use_side u ON f.farm_id = u.farm_id LEFT JOIN yield_side y ON f.farm_id = y.farm_id""",
    }


FARM_RANKED = """SELECT *,
    ROW_NUMBER() OVER (ORDER BY avg_yield_percentage DESC NULLS LAST, farm_id, farm_type NULLS LAST) AS yield_rank,
    ROW_NUMBER() OVER (ORDER BY avg_sustainability_score DESC NULLS LAST, farm_id, farm_type NULLS LAST)
      AS sustainability_rank,
    ROW_NUMBER() OVER (PARTITION BY farm_type ORDER BY avg_actual_yield DESC NULLS LAST, farm_id) AS yield_rank_in_type
    FROM metrics"""


def farm_sql(source: str, scale: int = 4, **more: str) -> str:
    return sql(FARM_RANKED, **more, **farm_sides(source, scale))


@query("farm_performance", farm_sql("records"))
def farm_performance(b: Binding) -> DataFrame:
    return marts.farm_performance(
        b.farms, b.records, b.soil, b.sustainability, b.yields, AS_OF_YEAR, RECORDS
    )


def refreshed(b: Binding, rollup: refresh.Rollup, label: str) -> DataFrame:
    """State of a roll-up of the records, which are joined once, and committed and counted in two parts."""
    source = CommittedTable(b.spark, new_path(b.spark, f"{label}-records"), "period", ["farm_id"])
    state = rollup.state_table(b.spark, new_path(b.spark, f"{label}-state"), "period")
    # Each part is read for the ranges of its keys and to be written.
    dated = materialise(b.records.withColumn("period", F.col("year").cast("string")), f"{label}-dated")
    for part in (F.col("month") <= 6, F.col("month") > 6):
        source.append(dated.where(part))
        refresh.refresh(source, state, rollup)
    return state.read()


@query("farm_performance_refreshed", farm_sql("records"))
def farm_performance_refreshed(b: Binding) -> DataFrame:
    """The farm mart, of whose records only the new ones are aggregated."""
    rollup = refresh.farm_rollup(RECORDS)
    by_type = refresh.farm_side(refreshed(b, rollup, "farm"), rollup, AS_OF_YEAR)
    return marts.farm_performance(
        b.farms, None, b.soil, b.sustainability, b.yields, AS_OF_YEAR, RECORDS, by_type=by_type
    )


@query("farm_performance_synth", farm_sql("staged", 6, staged=STAGED_FULL_DATA))
def farm_performance_synth(b: Binding) -> DataFrame:
    """The farm mart over the seed-derived records."""
    records = seeded.staged_full_data(b.shared().seeds, AS_OF)
    return marts.farm_performance(
        b.farms, records, b.soil, b.sustainability, b.yields, AS_OF_YEAR, FixedPoint(6, RATIO, AMOUNT)
    )


def product_mean(name: str, others: str, scale: int = 4) -> str:
    return (
        f"CAST(SUM(CAST(sum_{name} * {others} AS DECIMAL(38,{scale}))) AS DOUBLE) / "
        f"NULLIF(CAST(SUM(CAST(n_{name} * {others} AS DECIMAL(38,0))) AS DOUBLE), 0)"
    )


KY, KP, KH = (f"COALESCE({k}, 1)::DOUBLE" for k in ("ky", "kp", "kh"))


def crop_sql() -> str:
    return sql(
        """SELECT *, ROW_NUMBER() OVER (ORDER BY avg_yield_percentage DESC NULLS LAST, crop_type, crop_variety,
        crop_name, growing_season, water_needs) AS yield_efficiency_rank FROM metrics""",
        by_type=f"""SELECT crop_type, {mean('expected_yield')} AS avg_expected_yield,
            {mean('actual_yield')} AS avg_actual_yield, {mean('growing_period_days')} AS avg_growing_period_days,
            COUNT(DISTINCT farm_id) AS farm_count, {mean('sustainability_score')} AS avg_sustainability_score,
            {year_mean('year = 2001')} AS current_year_yield, {year_mean('year = 2000')} AS previous_year_yield,
            {year_mean('month IN (3, 4, 5)')} AS spring_yield, {year_mean('month IN (6, 7, 8)')} AS summer_yield,
            {year_mean('month IN (9, 10, 11)')} AS fall_yield, {year_mean('month IN (12, 1, 2)')} AS winter_yield,
            {mean('yield_percentage')} AS avg_yield_percentage FROM records GROUP BY crop_type""",
        sums=f"""SELECT c.crop_id, c.crop_type, c.crop_name, c.growing_season, c.water_needs, ky, sum_y, n_y, kp, sum_q,
            n_q, sum_c, n_c, sum_e, n_e, kh, sum_h, n_h FROM crops c
            LEFT JOIN (SELECT crop_id, COUNT(*) AS ky, {total('yield_per_hectare')} AS sum_y,
                COUNT(yield_per_hectare) AS n_y FROM yields GROUP BY crop_id) y ON c.crop_id = y.crop_id
            LEFT JOIN (SELECT crop_id, COUNT(*) AS kp, {total('quantity_produced')} AS sum_q,
                COUNT(quantity_produced) AS n_q, {total('cost')} AS sum_c, COUNT(cost) AS n_c,
                {total('quantity_produced / NULLIF(cost, 0)', 10)} AS sum_e,
                COUNT(quantity_produced / NULLIF(cost, 0)) AS n_e
                FROM production GROUP BY crop_id) p ON c.crop_id = p.crop_id
            LEFT JOIN (SELECT crop_id, COUNT(*) AS kh, {total('yield_amount')} AS sum_h, COUNT(yield_amount) AS n_h
                FROM harvest GROUP BY crop_id) h ON c.crop_id = h.crop_id""",
        by_crop=f"""SELECT crop_type, crop_name, growing_season, water_needs,
            {product_mean('y', f'({KP} * {KH})')} AS avg_yield_per_hectare,
            {product_mean('q', f'({KY} * {KH})')} AS avg_quantity_produced,
            {product_mean('c', f'({KY} * {KH})')} AS avg_production_cost,
            {product_mean('e', f'({KY} * {KH})', 10)} AS production_efficiency,
            {product_mean('h', f'({KY} * {KP})')} AS avg_harvest_yield
            FROM sums GROUP BY crop_type, crop_name, growing_season, water_needs""",
        metrics="""SELECT c.crop_type, crop_name AS crop_variety, crop_name, growing_season, water_needs,
            avg_expected_yield, avg_actual_yield, avg_growing_period_days,
            avg_actual_yield / NULLIF(avg_expected_yield, 0) * 100 AS yield_efficiency_pct, avg_yield_per_hectare,
            avg_quantity_produced, avg_production_cost, production_efficiency, avg_harvest_yield,
            COALESCE(farm_count, 0) AS farm_count, avg_sustainability_score, current_year_yield, previous_year_yield,
            (current_year_yield / NULLIF(previous_year_yield, 0) - 1) * 100 AS yoy_growth_pct, spring_yield,
            summer_yield, fall_yield, winter_yield, avg_yield_percentage,
            avg_yield_percentage * 0.5::DOUBLE + production_efficiency / 10 * 0.3::DOUBLE
            + avg_yield_per_hectare / 5 * 0.2::DOUBLE AS crop_performance_score
            FROM by_crop c LEFT JOIN by_type t ON c.crop_type = t.crop_type""",
    )


@query("crop_performance", crop_sql())
def crop_performance(b: Binding) -> DataFrame:
    b.shared()
    return marts.crop_performance(b.crops, b.records, b.yields, b.production, b.harvest, AS_OF_YEAR, RECORDS)


@query(
    "seasonal_performance",
    sql(
        """SELECT farm_id, farm_name, farm_location, crop_id, crop_name, crop_type, year, season, avg_yield,
        avg_expected_yield, avg_yield_percentage, avg_sustainability_score, avg_growing_period,
        avg_yield - LAG(avg_yield, 1) OVER (PARTITION BY farm_id, crop_id, season ORDER BY year)
          AS yield_change_from_previous_year,
        (SELECT AVG(temperature) FROM weather) AS avg_temperature,
        (SELECT AVG(precipitation) FROM weather) AS avg_precipitation,
        (SELECT AVG(humidity) FROM weather) AS avg_humidity,
        CASE WHEN avg_yield_percentage < 80 AND season = 'Summer'
          THEN 'Consider additional irrigation or heat-resistant varieties'
          WHEN avg_yield_percentage < 80 AND season = 'Winter'
          THEN 'Consider cold protection measures or winter-hardy varieties'
          WHEN avg_yield_percentage < 80 THEN 'Review growing conditions and varieties'
          ELSE 'Current practices are effective' END AS season_recommendations,
        CASE WHEN avg_yield_percentage >= 95 THEN 5 WHEN avg_yield_percentage >= 85 THEN 4
          WHEN avg_yield_percentage >= 75 THEN 3 WHEN avg_yield_percentage >= 65 THEN 2 ELSE 1 END
          AS season_performance_rating FROM base""",
        base=f"""SELECT r.farm_id, farm_name, farm_location, r.crop_id, crop_name, c.crop_type, year,
            {season('month')} AS season, {mean('actual_yield')} AS avg_yield,
            {mean('expected_yield')} AS avg_expected_yield, {mean('yield_percentage')} AS avg_yield_percentage,
            {mean('sustainability_score')} AS avg_sustainability_score,
            {mean('growing_period_days')} AS avg_growing_period
            FROM records r LEFT JOIN farms f ON r.farm_id = f.farm_id
            LEFT JOIN crops c ON TRY_CAST(r.crop_id AS BIGINT) = c.crop_id
            GROUP BY r.farm_id, farm_name, farm_location, r.crop_id, crop_name, c.crop_type, year, {season('month')}""",
    ),
)
def seasonal_performance(b: Binding) -> DataFrame:
    return marts.seasonal_performance(b.records, b.farms, b.crops, b.weather, RECORDS)


@query(
    "sustainability_metrics",
    sql(
        f"""SELECT r.farm_id, farm_name, farm_location, r.crop_type AS farm_type, r.crop_id, crop_name, c.crop_type,
        water_needs, year, month, sustainability_score, water_usage, carbon_footprint, pesticide_usage, ph_level,
        organic_matter, farm_size_acres, CAST(DATE_TRUNC('month', planting_date) AS DATE) AS planting_month,
        (SELECT AVG(precipitation) FROM weather) AS avg_precipitation,
        (SELECT AVG(humidity) FROM weather) AS avg_humidity,
        COALESCE(sustainability_score, 0) * 0.4::DOUBLE + (100 - COALESCE(water_usage, 0)) * 0.2::DOUBLE
          + (100 - COALESCE(carbon_footprint, 0)) * 0.2::DOUBLE + (100 - COALESCE(pesticide_usage, 0)) * 0.2::DOUBLE
          AS comprehensive_sustainability_score,
        CASE WHEN sustainability_score >= 80 THEN 5 WHEN sustainability_score >= 60 THEN 4
          WHEN sustainability_score >= 40 THEN 3 WHEN sustainability_score >= 20 THEN 2 ELSE 1 END
          AS sustainability_tier,
        {mean('soil_moisture')} AS avg_soil_moisture, {mean('soil_temperature')} AS avg_soil_temperature,
        CASE water_needs WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 WHEN 'Very High' THEN 4 ELSE 0 END
          AS water_need_rating,
        actual_yield / NULLIF(water_usage, 0) AS water_efficiency,
        actual_yield / NULLIF(carbon_footprint, 0) AS carbon_efficiency,
        actual_yield / NULLIF(expected_yield, 0) * 100 AS resource_efficiency,
        actual_yield / NULLIF(farm_size_acres, 0) AS yield_density, growing_period_days AS growing_period,
        sustainability_score / CASE WHEN farm_size_acres > 0 THEN SQRT(farm_size_acres) END AS size_normalized_score,
        sustainability_score / NULLIF(actual_yield, 0) AS yield_normalized_score
        FROM records r LEFT JOIN farms f ON r.farm_id = f.farm_id
        LEFT JOIN sustainability u ON r.farm_id = u.farm_id LEFT JOIN soil s ON r.farm_id = s.farm_id
        LEFT JOIN crops c ON TRY_CAST(r.crop_id AS BIGINT) = c.crop_id
        WHERE sustainability_score IS NOT NULL
        GROUP BY r.farm_id, farm_name, farm_location, r.crop_type, r.crop_id, crop_name, c.crop_type, water_needs,
        year, month, planting_date, sustainability_score, water_usage, carbon_footprint, pesticide_usage, ph_level,
        organic_matter, farm_size_acres, actual_yield, expected_yield, growing_period_days"""
    ),
)
def sustainability_metrics(b: Binding) -> DataFrame:
    return marts.sustainability_metrics(
        b.records, b.farms, b.sustainability, b.soil, b.crops, b.weather, RECORDS
    )


@query("crop_performance_refreshed", crop_sql())
def crop_performance_refreshed(b: Binding) -> DataFrame:
    """The crop mart, of whose records only the new ones are aggregated."""
    b.shared()
    rollup = refresh.crop_rollup(RECORDS)
    by_type = refresh.crop_side(refreshed(b, rollup, "crop"), rollup, AS_OF_YEAR)
    return marts.crop_performance(
        b.crops, None, b.yields, b.production, b.harvest, AS_OF_YEAR, RECORDS, by_type=by_type
    )
