"""The four data marts.

The marts join many-sided tables to one key. Where such a join multiplies rows only to average them again, the
sides are aggregated before they meet (see ``operators.fanout``); the results are those of the multiplied join.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.bindings import agri
from martflow.functions import aggregate as agg
from martflow.functions import scalar
from martflow.functions.aggregate import FixedPoint
from martflow.operators.conform import audited
from martflow.operators.fanout import Side, join_condensed, product_mean, repeats
from martflow.operators.joins import attach_summary, combined, dealt_once, is_even, join_cast_key, one_per_key, sent_whole, star
from martflow.operators.ranking import Rank, add_ranks, change_from_previous

# Tiers, ratings and needs.
SUSTAINABILITY_TIERS = ([(80, 5), (60, 4), (40, 3), (20, 2)], 1)
SEASON_RATINGS = ([(95, 5), (85, 4), (75, 3), (65, 2)], 1)
WATER_NEED_RATING = {"Low": 1, "Medium": 2, "High": 3, "Very High": 4}
WATER_NEED_OTHERWISE = 0
LOW_YIELD = 80

# Season recommendations.
RECOMMEND_SUMMER = "Consider additional irrigation or heat-resistant varieties"
RECOMMEND_WINTER = "Consider cold protection measures or winter-hardy varieties"
RECOMMEND_REVIEW = "Review growing conditions and varieties"
RECOMMEND_NOTHING = "Current practices are effective"


NOT_EXACT = FixedPoint(None, None, None)
# The crop of a record as a number.
CROP_KEY = "_crop_key"


def season_advice(percentage: scalar.ColumnLike, season: scalar.ColumnLike) -> Column:
    low = scalar.col(percentage) < LOW_YIELD
    season = scalar.col(season)
    return scalar.first_match(
        [
            (low & (season == "Summer"), RECOMMEND_SUMMER),
            (low & (season == "Winter"), RECOMMEND_WINTER),
            (low, RECOMMEND_REVIEW),
        ],
        RECOMMEND_NOTHING,
    )


def farm_performance(
    farms: DataFrame,
    records: DataFrame | None,
    soil: DataFrame,
    sustainability: DataFrame,
    yields: DataFrame,
    as_of_year: int,
    exact: FixedPoint | None = None,
    fanout: str = "reference",
    by_type: DataFrame | None = None,
) -> DataFrame:
    """Performance of each farm by crop type, with three ranks.

    Soil, sustainability and yield rows of a farm repeat its records. That leaves averages as they are but
    multiplies the total yield; ``fanout="none"`` reports the plain total. ``by_type`` stands for the aggregated records, as
    ``refresh.farm_side`` keeps them.
    """
    exact = exact or NOT_EXACT
    by_type = by_type or records.groupBy("farm_id", F.col("crop_type").alias("farm_type")).agg(
        agg.mean("soil_moisture", exact.measure).alias("avg_soil_moisture"),
        agg.mean("soil_temperature", exact.measure).alias("avg_soil_temperature"),
        agg.mean("actual_yield", exact.measure).alias("avg_actual_yield"),
        agg.mean("expected_yield", exact.measure).alias("avg_expected_yield"),
        agg.total("actual_yield", exact.measure).alias("plain_total"),
        agg.mean("yield_percentage", exact.measure).alias("avg_yield_percentage"),
        agg.mean("sustainability_score", exact.measure).alias("avg_sustainability_score"),
        agg.mean_since_year("year", as_of_year - 1, "actual_yield", exact.measure).alias("recent_avg_yield"),
        agg.mean("growing_period_days", exact.measure).alias("avg_growing_period"),
        agg.mean_of_ratio("actual_yield", "farm_size_acres", exact.ratio).alias("yield_per_acre"),
    )
    soil_by_farm = soil.groupBy("farm_id").agg(
        F.count(F.lit(1)).alias("_copies_soil"),
        agg.mean("ph_level", exact.amount).alias("avg_soil_ph"),
        agg.mean("organic_matter", exact.amount).alias("avg_organic_matter"),
    )
    use_by_farm = sustainability.groupBy("farm_id").agg(
        F.count(F.lit(1)).alias("_copies_sustainability"),
        agg.mean("water_usage", exact.amount).alias("avg_water_usage"),
        agg.mean("carbon_footprint", exact.amount).alias("avg_carbon_footprint"),
        agg.mean("pesticide_usage", exact.amount).alias("avg_pesticide_usage"),
        agg.mean_or("water_usage", 0, exact.amount).alias("water"),
        agg.mean_or("carbon_footprint", 0, exact.amount).alias("carbon"),
    )
    yield_by_farm = yields.groupBy("farm_id").agg(
        F.count(F.lit(1)).alias("_copies_yield"),
        agg.mean("yield_per_hectare", exact.amount).alias("avg_yield_per_hectare"),
    )
    named = farms.select("farm_id", "farm_name", "farm_location", "farm_size")
    if fanout == "reference":
        base = farms.groupBy(F.col("farm_id").alias("_base_id")).agg(F.count(F.lit(1)).alias("_copies_base"))
        named = named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("_copies_named"))
        # A farm without an id stays, as in a left join.
        named = named.join(base, F.col("farm_id").eqNullSafe(F.col("_base_id"))).drop("_base_id")
        copies = repeats(["base", "named", "soil", "sustainability", "yield"])
    else:
        named = one_per_key(named, ["farm_id"])
        copies = F.lit(1.0)
    joined = star(
        named, [(side, ["farm_id"]) for side in (by_type, soil_by_farm, use_by_farm, yield_by_farm)]
    )
    score = (
        F.col("avg_yield_percentage") * 0.4
        + F.col("avg_sustainability_score") * 0.3
        + (100 - scalar.or_default("water", 0.0) * 0.1)
        + (100 - scalar.or_default("carbon", 0.0) * 0.2)
    )
    metrics = joined.select(
        "farm_id", "farm_name", "farm_location", "farm_type",
        F.col("farm_size").alias("avg_farm_size_acres"),
        "avg_soil_moisture", "avg_soil_temperature", "avg_soil_ph", "avg_organic_matter", "avg_water_usage",
        "avg_carbon_footprint", "avg_pesticide_usage", "avg_yield_per_hectare", "avg_actual_yield",
        "avg_expected_yield",
        (F.col("plain_total") * copies).alias("total_actual_yield"),
        "avg_yield_percentage", "avg_sustainability_score", "recent_avg_yield", "avg_growing_period",
        "yield_per_acre",
        score.alias("farm_performance_score"),
    )
    ties = ["farm_id", "farm_type", "farm_name", "farm_location", "avg_farm_size_acres"]
    return add_ranks(
        metrics,
        [
            Rank("yield_rank", "avg_yield_percentage", ties),
            Rank("sustainability_rank", "avg_sustainability_score", ties),
            Rank("yield_rank_in_type", "avg_actual_yield", ties, within=["farm_type"]),
        ],
    )


def crop_performance(
    crops: DataFrame,
    records: DataFrame | None,
    yields: DataFrame,
    production: DataFrame,
    harvest: DataFrame,
    as_of_year: int,
    exact: FixedPoint | None = None,
    fanout: str = "reference",
    by_type: DataFrame | None = None,
) -> DataFrame:
    """Performance of each crop (type, name, season, water needs), with its rank.

    A crop meets all records of its type, and its yields, productions and harvests multiply one another.
    Records are aggregated once per type, the others once per crop, and recombined by their row counts.
    ``fanout="none"`` weighs every yield, production and harvest row once. ``by_type`` stands for the aggregated records, as
    ``refresh.crop_side`` keeps them.
    """
    exact = exact or NOT_EXACT
    by_type = by_type or records.groupBy("crop_type").agg(
        agg.mean("expected_yield", exact.measure).alias("avg_expected_yield"),
        agg.mean("actual_yield", exact.measure).alias("avg_actual_yield"),
        agg.mean("growing_period_days", exact.measure).alias("avg_growing_period_days"),
        agg.distinct_count("farm_id", apart=True).alias("farm_count"),
        agg.mean("sustainability_score", exact.measure).alias("avg_sustainability_score"),
        agg.mean_in_year("year", as_of_year, "actual_yield", exact.measure).alias("current_year_yield"),
        agg.mean_in_year("year", as_of_year - 1, "actual_yield", exact.measure).alias("previous_year_yield"),
        *[
            value.alias(f"{season}_yield")
            for season, value in agg.season_means("month", "actual_yield", exact.measure).items()
        ],
        agg.mean("yield_percentage", exact.measure).alias("avg_yield_percentage"),
    )
    yield_side = Side("yield", yields, "crop_id", {"per_hectare": (F.col("yield_per_hectare"), exact.amount)})
    production_side = Side(
        "production",
        production,
        "crop_id",
        {
            "quantity": (F.col("quantity_produced"), exact.amount),
            "cost": (F.col("cost"), exact.amount),
            "efficiency": (scalar.safe_ratio("quantity_produced", "cost"), exact.ratio),
        },
    )
    harvest_side = Side("harvest", harvest, "crop_id", {"amount": (F.col("yield_amount"), exact.amount)})
    sides = [yield_side, production_side, harvest_side]
    key = ["crop_type", "crop_variety", "crop_name", "growing_season", "water_needs"]
    if fanout == "reference":
        met = ["base", "named", *[side.name for side in sides]]
        base = crops.groupBy("crop_id", "crop_type", F.col("crop_name").alias("crop_variety")).agg(
            F.count(F.lit(1)).alias("_copies_base")
        )
        named = crops.groupBy("crop_id", "crop_name", "growing_season", "water_needs").agg(
            F.count(F.lit(1)).alias("_copies_named")
        )
        named = base.join(named, "crop_id", "left")
    else:
        met = []
        single = one_per_key(
            crops.select("crop_id", "crop_type", "crop_name", "growing_season", "water_needs"), ["crop_id"]
        )
        named = single.withColumn("crop_variety", F.col("crop_name"))
    by_crop = (
        join_condensed(named, sides)
        .groupBy(*key)
        .agg(
            product_mean(yield_side, met, "per_hectare").alias("avg_yield_per_hectare"),
            product_mean(production_side, met, "quantity").alias("avg_quantity_produced"),
            product_mean(production_side, met, "cost").alias("avg_production_cost"),
            product_mean(production_side, met, "efficiency").alias("production_efficiency"),
            product_mean(harvest_side, met, "amount").alias("avg_harvest_yield"),
        )
    )
    score = (
        F.col("avg_yield_percentage") * 0.5
        + F.col("production_efficiency") / 10 * 0.3
        + F.col("avg_yield_per_hectare") / 5 * 0.2
    )
    metrics = by_crop.join(by_type, "crop_type", "left").select(
        *key, "avg_expected_yield", "avg_actual_yield",
        "avg_growing_period_days",
        scalar.percent_of("avg_actual_yield", "avg_expected_yield").alias("yield_efficiency_pct"),
        "avg_yield_per_hectare", "avg_quantity_produced", "avg_production_cost", "production_efficiency",
        "avg_harvest_yield",
        F.coalesce("farm_count", F.lit(0).cast("bigint")).alias("farm_count"),
        "avg_sustainability_score", "current_year_yield", "previous_year_yield",
        scalar.growth_percent("current_year_yield", "previous_year_yield").alias("yoy_growth_pct"),
        "spring_yield", "summer_yield", "fall_yield", "winter_yield", "avg_yield_percentage",
        score.alias("crop_performance_score"),
    )
    return add_ranks(metrics, [Rank("yield_efficiency_rank", "avg_yield_percentage", key)])


def seasonal_performance(
    records: DataFrame, farms: DataFrame, crops: DataFrame, weather: DataFrame, exact: FixedPoint | None = None,
    even_crops: bool = False,
) -> DataFrame:
    """Performance of each farm and crop by year and season, with its change, advice and rating.

    Records are averaged before farms and crops are joined to them, and the weather every row meets is one
    summary row. With ``even_crops``, where no crop is hot, they are shuffled once, by crop, for the averages, the changes
    and the join of crops.
    """
    exact = exact or NOT_EXACT
    keyed = records.select(
        "farm_id", "crop_id", "year", scalar.season_of("month").alias("season"), "actual_yield", "expected_yield",
        "yield_percentage", "sustainability_score", "growing_period_days", scalar.as_id("crop_id").alias(CROP_KEY),
    )
    metrics = (
        dealt_once(keyed, CROP_KEY, even_crops)
        .groupBy(CROP_KEY, "farm_id", "crop_id", "year", "season")
        .agg(
            agg.mean("actual_yield", exact.measure).alias("avg_yield"),
            agg.mean("expected_yield", exact.measure).alias("avg_expected_yield"),
            agg.mean("yield_percentage", exact.measure).alias("avg_yield_percentage"),
            agg.mean("sustainability_score", exact.measure).alias("avg_sustainability_score"),
            agg.mean("growing_period_days", exact.measure).alias("avg_growing_period"),
        )
    )
    changed = change_from_previous(
        metrics, "avg_yield", [CROP_KEY, "farm_id", "crop_id", "season"], "year", "yield_change_from_previous_year"
    )
    farm_names = sent_whole(farms.select("farm_id", "farm_name", "farm_location").distinct())
    crop_names = crops.select(F.col("crop_id").alias("key"), "crop_name", "crop_type").distinct()
    named = join_cast_key(changed.join(farm_names, "farm_id", "left"), crop_names, CROP_KEY, "key")
    attached = attach_summary(
        named,
        weather,
        {
            "avg_temperature": agg.mean("temperature", exact.amount),
            "avg_precipitation": agg.mean("precipitation", exact.amount),
            "avg_humidity": agg.mean("humidity", exact.amount),
        },
    )
    return attached.select(
        "farm_id", "farm_name", "farm_location", "crop_id", "crop_name", "crop_type", "year", "season",
        "avg_yield", "avg_expected_yield", "avg_yield_percentage", "avg_sustainability_score",
        "avg_growing_period", "yield_change_from_previous_year", "avg_temperature", "avg_precipitation",
        "avg_humidity",
        season_advice("avg_yield_percentage", "season").alias("season_recommendations"),
        scalar.band("avg_yield_percentage", *SEASON_RATINGS, inclusive=True).alias("season_performance_rating"),
    )


# Columns that identify a row of the sustainability mart; the planting date counts but is not shown.
SUSTAINABILITY_KEYS = [
    "farm_id", "farm_name", "farm_location", "farm_type", "crop_id", "crop_name", "crop_type", "water_needs",
    "year", "month", "planting_date", "sustainability_score", "water_usage", "carbon_footprint",
    "pesticide_usage", "ph_level", "organic_matter", "farm_size_acres", "actual_yield", "expected_yield",
    "growing_period_days",
]


def sustainability_score() -> Column:
    return scalar.weighted_sum(
        [
            (scalar.or_default("sustainability_score", 0), 0.4),
            (100 - scalar.or_default("water_usage", 0), 0.2),
            (100 - scalar.or_default("carbon_footprint", 0), 0.2),
            (100 - scalar.or_default("pesticide_usage", 0), 0.2),
        ]
    )


def sustainability_metrics(
    records: DataFrame,
    farms: DataFrame,
    sustainability: DataFrame,
    soil: DataFrame,
    crops: DataFrame,
    weather: DataFrame,
    exact: FixedPoint | None = None,
    fanout: str = "reference",
    even_crops: bool = False,
) -> DataFrame:
    """Sustainability of each distinct record, with scores, tier and efficiencies.

    Records are grouped by their own columns before the joins, which leaves equal results: the joined columns
    are grouping keys, and each record of a farm and crop meets the same rows. Several sustainability or soil
    rows of a farm give one result row each; with ``fanout="none"`` one of them is taken. With ``even_crops``, where
    no crop is hot, records are shuffled once, by crop, for the groups and the join of crops.
    """
    exact = exact or NOT_EXACT
    own_keys = [
        "farm_id", "crop_type", "crop_id", "year", "month", "planting_date", "sustainability_score",
        "farm_size_acres", "actual_yield", "expected_yield", "growing_period_days",
    ]
    keyed = records.where(F.col("sustainability_score").isNotNull()).select(
        *own_keys, "soil_moisture", "soil_temperature", scalar.as_id("crop_id").alias(CROP_KEY)
    )
    condensed = (
        dealt_once(keyed, CROP_KEY, even_crops)
        .groupBy(CROP_KEY, *own_keys)
        .agg(
            agg.mean("soil_moisture", exact.measure).alias("avg_soil_moisture"),
            agg.mean("soil_temperature", exact.measure).alias("avg_soil_temperature"),
        )
        .withColumnRenamed("crop_type", "farm_type")
    )
    dimensions = [
        farms.select("farm_id", "farm_name", "farm_location"),
        sustainability.select("farm_id", "water_usage", "carbon_footprint", "pesticide_usage"),
        soil.select("farm_id", "ph_level", "organic_matter"),
    ]
    crop_names = crops.select(F.col("crop_id").alias("key"), "crop_name", "crop_type", "water_needs")
    if fanout == "none":
        dimensions = [one_per_key(d, ["farm_id"]) for d in dimensions]
        crop_names = one_per_key(crop_names, ["key"])
    else:
        dimensions = [d.distinct() for d in dimensions]
        crop_names = crop_names.distinct()
    named = condensed.join(sent_whole(combined(dimensions, ["farm_id"])), "farm_id", "left")
    joined = join_cast_key(named, crop_names, CROP_KEY, "key")
    attached = attach_summary(
        joined,
        weather,
        {
            "avg_precipitation": agg.mean("precipitation", exact.amount),
            "avg_humidity": agg.mean("humidity", exact.amount),
        },
    )
    return attached.select(
        *[c for c in SUSTAINABILITY_KEYS if c not in
          ("planting_date", "actual_yield", "expected_yield", "growing_period_days")],
        scalar.month_floor("planting_date").alias("planting_month"),
        "avg_precipitation",
        "avg_humidity",
        sustainability_score().alias("comprehensive_sustainability_score"),
        scalar.band("sustainability_score", *SUSTAINABILITY_TIERS, inclusive=True).alias("sustainability_tier"),
        "avg_soil_moisture",
        "avg_soil_temperature",
        scalar.value_map("water_needs", WATER_NEED_RATING, WATER_NEED_OTHERWISE).alias("water_need_rating"),
        scalar.safe_ratio("actual_yield", "water_usage").alias("water_efficiency"),
        scalar.safe_ratio("actual_yield", "carbon_footprint").alias("carbon_efficiency"),
        scalar.percent_of("actual_yield", "expected_yield").alias("resource_efficiency"),
        scalar.safe_ratio("actual_yield", "farm_size_acres").alias("yield_density"),
        F.col("growing_period_days").alias("growing_period"),
        scalar.per_root("sustainability_score", "farm_size_acres").alias("size_normalized_score"),
        scalar.safe_ratio("sustainability_score", "actual_yield").alias("yield_normalized_score"),
    )


def published(mart: DataFrame, name: str, as_of: datetime) -> DataFrame:
    """A mart in the column order of its contract, with its audit time."""
    return audited(mart, as_of, "generated_at").select(*agri.MARTS[name])


def all_marts(
    records: DataFrame, staged: Mapping[str, DataFrame], as_of: datetime, exact: FixedPoint | None = None
) -> dict[str, DataFrame]:
    """All marts over staged records and the staging views (``stg_farm``, ``stg_crop`` and so on).

    One pass over the records' crops tells whether those are even.
    """
    even = is_even(records, scalar.as_id("crop_id"))
    farms, crops, weather = staged["stg_farm"], staged["stg_crop"], staged["stg_weather"]
    soil, use, yields = staged["stg_soil"], staged["stg_sustainability"], staged["stg_yield"]
    marts = {
        "farm_performance": farm_performance(farms, records, soil, use, yields, as_of.year, exact),
        "crop_performance": crop_performance(
            crops, records, yields, staged["stg_production"], staged["stg_harvest"], as_of.year, exact
        ),
        "seasonal_performance": seasonal_performance(records, farms, crops, weather, exact, even),
        "sustainability_metrics": sustainability_metrics(
            records, farms, use, soil, crops, weather, exact, even_crops=even
        ),
    }
    return {name: published(mart, name, as_of) for name, mart in marts.items()}
