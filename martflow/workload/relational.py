"""Scans, shaping, joins, aggregates and ranks over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.bindings.testdata import MEASURE, Binding
from martflow.functions import aggregate as agg
from martflow.functions import scalar
from martflow.operators import conform, joins
from martflow.operators.ranking import Rank, add_ranks, change_from_previous
from martflow.plans import olap
from martflow.sources.files import read_parquet
from martflow.workload.ansi import mean, season, sql, total
from martflow.workload.registry import query
from martflow.workload.scalars import LINE, LINE_SQL

AS_OF_YEAR = 2001
AMOUNT = "decimal(18,4)"
RATIO = 10


@query("scan_glob_count", "SELECT COUNT(*) AS n_rows FROM lineitem")
def scan_glob_count(b: Binding) -> DataFrame:
    lines = read_parquet(b.spark, b.directory, glob="lineitem*.parquet")
    return lines.agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "cast_fill_nulls",
    f"SELECT {LINE_SQL}, COALESCE(CAST(NULLIF(l_linenumber, 3) AS DOUBLE), 0) AS amount FROM lineitem",
)
def cast_fill_nulls(b: Binding) -> DataFrame:
    drifting = b.table("lineitem").select(*LINE, F.nullif("l_linenumber", F.lit(3)).alias("amount"))
    return conform.fill_nulls(conform.cast_present(drifting, ["amount", "absent"]), ["amount", "absent"])


@query(
    "union_by_name_missing",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
        UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
        UNION ALL SELECT n_nationkey, n_name, NULL, NULL FROM nation""",
)
def union_by_name_missing(b: Binding) -> DataFrame:
    return conform.union_all(
        [
            conform.pick(b.table("supplier"), {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"}),
            conform.pick(
                b.table("customer"),
                {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"},
            ),
            conform.pick(b.table("nation"), {"n_nationkey": "id", "n_name": "name"}),
        ]
    )


@query(
    "align_schema",
    """SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, CAST(NULL AS DATE) AS since
        FROM customer""",
)
def align_schema(b: Binding) -> DataFrame:
    named = conform.rename(
        b.table("customer"), {"c_custkey": "id", "c_name": "name", "c_nationkey": "nation"}
    )
    return conform.align(named, T.StructType.fromDDL("id bigint, name string, nation bigint, since date"))


@query(
    "rename_audit",
    """SELECT p_partkey AS crop_id, p_name AS crop_name, p_type AS crop_type, 'kg' AS unit,
        DATE '2024-01-01' AS loaded_at FROM part""",
)
def rename_audit(b: Binding) -> DataFrame:
    picked = conform.pick(b.table("part"), {"p_partkey": "crop_id", "p_name": "crop_name", "p_type": "crop_type"})
    return conform.audited(conform.with_constants(picked, {"unit": "kg"}), F.lit(date(2024, 1, 1)))


@query(
    "latest_by_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM orders
        QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_by_key(b: Binding) -> DataFrame:
    orders = b.table("orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_totalprice"
    )
    return conform.latest_by_key(orders, ["o_custkey"], "order_date")


@query(
    "filter_not_null",
    sql(
        """SELECT f.farm_id, ph_level FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id
        WHERE ph_level IS NOT NULL"""
    ),
)
def filter_not_null(b: Binding) -> DataFrame:
    return b.farms.join(b.soil, "farm_id", "left").where(F.col("ph_level").isNotNull()).select("farm_id", "ph_level")


# Joins


@query(
    "join_inner",
    f"""SELECT {LINE_SQL}, o_custkey, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner(b: Binding) -> DataFrame:
    joined = b.table("lineitem").join(b.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    return joined.select(*LINE, "o_custkey", "o_totalprice")


@query(
    "join_left",
    sql(
        """SELECT f.farm_id, farm_name, ph_level, organic_matter FROM farms f
        LEFT JOIN soil s ON f.farm_id = s.farm_id"""
    ),
)
def join_left(b: Binding) -> DataFrame:
    return b.farms.join(b.soil, "farm_id", "left").select("farm_id", "farm_name", "ph_level", "organic_matter")


@query(
    "join_left_composite",
    sql(
        """SELECT l_orderkey, l_linenumber, l_suppkey AS farm_id, l_partkey AS crop_id, yield_amount
        FROM lineitem LEFT JOIN harvest h ON l_suppkey = h.farm_id AND l_partkey = h.crop_id"""
    ),
)
def join_left_composite(b: Binding) -> DataFrame:
    lines = conform.rename(
        b.table("lineitem").select(*LINE), {"l_suppkey": "farm_id", "l_partkey": "crop_id"}
    )
    amounts = b.harvest.select("farm_id", "crop_id", "yield_amount")
    return joins.star(lines, [(amounts, ["farm_id", "crop_id"])]).select(
        "l_orderkey", "l_linenumber", "farm_id", "crop_id", "yield_amount"
    )


@query(
    "join_star",
    sql(
        f"""SELECT f.farm_id, farm_name, farm_location, ph_level, water_usage, total_yield, n_harvests
        FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id
        LEFT JOIN sustainability u ON f.farm_id = u.farm_id
        LEFT JOIN (SELECT farm_id, {total('yield_amount', 2)} AS total_yield, COUNT(*) AS n_harvests
                   FROM harvest GROUP BY farm_id) h ON f.farm_id = h.farm_id"""
    ),
)
def join_star(b: Binding) -> DataFrame:
    harvested = b.harvest.groupBy("farm_id").agg(
        agg.total("yield_amount", AMOUNT).alias("total_yield"), F.count(F.lit(1)).alias("n_harvests")
    )
    joined = joins.star(
        b.farms, [(b.soil, ["farm_id"]), (b.sustainability, ["farm_id"]), (harvested, ["farm_id"])]
    )
    return joined.select(
        "farm_id", "farm_name", "farm_location", "ph_level", "water_usage", "total_yield", "n_harvests"
    )


@query(
    "join_many_to_many",
    sql(
        """SELECT crop_id, c.crop_type, COALESCE(n_pairs, 1) AS n_pairs, avg_actual, n_farms
        FROM crops c LEFT JOIN by_type t ON c.crop_type = t.crop_type""",
        by_type=f"""SELECT crop_type, COUNT(*) AS n_pairs, {mean('actual_yield')} AS avg_actual,
            COUNT(DISTINCT farm_id) AS n_farms FROM records GROUP BY crop_type""",
    ),
)
def join_many_to_many(b: Binding) -> DataFrame:
    """Averages over crops joined to all records of their type, without forming the pairs."""
    by_type = b.records.groupBy("crop_type").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        agg.mean("actual_yield", MEASURE).alias("avg_actual"),
        agg.distinct_count("farm_id").alias("n_farms"),
    )
    joined = b.crops.select("crop_id", "crop_type").join(by_type, "crop_type", "left")
    return joined.withColumn("n_pairs", F.coalesce("n_pairs", F.lit(1).cast("bigint")))


@query(
    "join_self_dim",
    sql("SELECT a.farm_id, a.farm_size, b.farm_name, b.farm_location FROM farms a LEFT JOIN farms b USING (farm_id)"),
)
def join_self_dim(b: Binding) -> DataFrame:
    """A dimension joined to itself on its key."""
    return joins.joined_to_itself(b.farms, ["farm_id"], ["farm_size"], ["farm_name", "farm_location"])


@query(
    "join_constant_lookup",
    sql(
        """SELECT f.farm_id, AVG(temperature) AS avg_temperature, AVG(precipitation) AS avg_precipitation,
        AVG(humidity) AS avg_humidity FROM farms f LEFT JOIN weather w ON 1 = 1 GROUP BY f.farm_id"""
    ),
)
def join_constant_lookup(b: Binding) -> DataFrame:
    return joins.attach_summary(
        b.farms.select("farm_id"),
        b.weather,
        {
            "avg_temperature": F.avg("temperature"),
            "avg_precipitation": F.avg("precipitation"),
            "avg_humidity": F.avg("humidity"),
        },
    )


@query(
    "join_key_cast",
    sql(
        """SELECT r.farm_id, r.crop_id, crop_name, growing_season FROM records r
        LEFT JOIN crops c ON TRY_CAST(r.crop_id AS BIGINT) = c.crop_id"""
    ),
)
def join_key_cast(b: Binding) -> DataFrame:
    base = b.records.select("farm_id", "crop_id")
    named = b.crops.select(F.col("crop_id").alias("key"), "crop_name", "growing_season")
    return joins.join_cast_key(base, named, "crop_id", "key")


@query(
    "join_via_key",
    """SELECT o_orderkey, o_custkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
)
def join_via_key(b: Binding) -> DataFrame:
    """Orders once per line of theirs, no column of the lines being used."""
    orders = b.table("orders").select("o_orderkey", "o_custkey")
    lines = b.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.repeat_by_matches(orders, lines, ["o_orderkey"])


# Aggregates


@query(
    "agg_multi_avg",
    sql(
        f"""SELECT "Farm_ID", "Farm_Type", {mean('"Farm_Size_Acres"')} AS "avg_Farm_Size_Acres",
        {mean('"Soil_Moisture"')} AS "avg_Soil_Moisture", {mean('"Soil_Temperature"')} AS "avg_Soil_Temperature"
        FROM raw GROUP BY "Farm_ID", "Farm_Type" """
    ),
)
def agg_multi_avg(b: Binding) -> DataFrame:
    return olap.farm_analysis(b.raw, MEASURE)


@query(
    "agg_crop_rollup",
    sql(
        f"""SELECT "Crop_Type", "Crop_Variety", {mean('"Expected_Yield"')} AS "avg_Expected_Yield",
        {mean('"Actual_Yield"')} AS "avg_Actual_Yield", {mean('"Growing_Period_Days"')} AS "avg_Growing_Period_Days"
        FROM raw GROUP BY "Crop_Type", "Crop_Variety" """
    ),
)
def agg_crop_rollup(b: Binding) -> DataFrame:
    return olap.crop_analysis(b.raw, MEASURE)


@query(
    "agg_count_distinct",
    """SELECT l_returnflag, COUNT(DISTINCT l_suppkey) AS n_farms, COUNT(DISTINCT l_partkey) AS n_crops, COUNT(*) AS n
        FROM lineitem GROUP BY l_returnflag""",
)
def agg_count_distinct(b: Binding) -> DataFrame:
    return b.table("lineitem").groupBy("l_returnflag").agg(
        agg.distinct_count("l_suppkey").alias("n_farms"),
        agg.distinct_count("l_partkey").alias("n_crops"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "agg_ratio_of_means",
    sql(
        f"""SELECT crop_type, {mean('actual_yield')} / NULLIF({mean('expected_yield')}, 0) * 100 AS efficiency
        FROM records GROUP BY crop_type"""
    ),
)
def agg_ratio_of_means(b: Binding) -> DataFrame:
    efficiency = agg.ratio_of_means_percent("actual_yield", "expected_yield", MEASURE)
    return b.records.groupBy("crop_type").agg(efficiency.alias("efficiency"))


@query(
    "agg_mean_of_ratio",
    sql(
        f"""SELECT farm_id, {mean('actual_yield / NULLIF(farm_size_acres, 0)', 10)} AS yield_per_acre,
        {total('actual_yield')} AS total_actual FROM records GROUP BY farm_id"""
    ),
)
def agg_mean_of_ratio(b: Binding) -> DataFrame:
    return b.records.groupBy("farm_id").agg(
        agg.mean_of_ratio("actual_yield", "farm_size_acres", RATIO).alias("yield_per_acre"),
        agg.total("actual_yield", MEASURE).alias("total_actual"),
    )


def year_mean(condition: str) -> str:
    return mean(f"CASE WHEN {condition} THEN actual_yield END")


@query(
    "agg_conditional_years",
    sql(
        f"""SELECT crop_type, {year_mean('year = 2001')} AS current_year, {year_mean('year = 2000')} AS previous_year,
        {year_mean('year >= 2000')} AS recent FROM records GROUP BY crop_type"""
    ),
)
def agg_conditional_years(b: Binding) -> DataFrame:
    return b.records.groupBy("crop_type").agg(
        agg.mean_in_year("year", AS_OF_YEAR, "actual_yield", MEASURE).alias("current_year"),
        agg.mean_in_year("year", AS_OF_YEAR - 1, "actual_yield", MEASURE).alias("previous_year"),
        agg.mean_since_year("year", AS_OF_YEAR - 1, "actual_yield", MEASURE).alias("recent"),
    )


@query(
    "agg_season_pivot",
    sql(
        f"""SELECT crop_type, {year_mean('month IN (3, 4, 5)')} AS spring, {year_mean('month IN (6, 7, 8)')} AS summer,
        {year_mean('month IN (9, 10, 11)')} AS fall, {year_mean('month IN (12, 1, 2)')} AS winter
        FROM records GROUP BY crop_type"""
    ),
)
def agg_season_pivot(b: Binding) -> DataFrame:
    means = agg.season_means("month", "actual_yield", MEASURE)
    return b.records.groupBy("crop_type").agg(*[value.alias(name) for name, value in means.items()])


@query(
    "agg_yoy_growth",
    sql(
        f"""SELECT farm_id, ({year_mean('year = 2001')} / NULLIF({year_mean('year = 2000')}, 0) - 1) * 100 AS growth
        FROM records GROUP BY farm_id"""
    ),
)
def agg_yoy_growth(b: Binding) -> DataFrame:
    growth = agg.year_over_year_percent("year", AS_OF_YEAR, "actual_yield", MEASURE)
    return b.records.groupBy("farm_id").agg(growth.alias("growth"))


@query(
    "agg_composite_score",
    sql(
        f"""SELECT f.farm_id, {mean('COALESCE(carbon_footprint, 0)')} AS avg_carbon, {mean('ph_level')} * 0.5
        + (100 - {mean('COALESCE(carbon_footprint, 0)')} * 0.2::DOUBLE) AS score
        FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id LEFT JOIN sustainability u ON f.farm_id = u.farm_id
        GROUP BY f.farm_id"""
    ),
)
def agg_composite_score(b: Binding) -> DataFrame:
    joined = joins.star(b.farms, [(b.soil, ["farm_id"]), (b.sustainability, ["farm_id"])])
    carbon = agg.mean_or("carbon_footprint", 0, AMOUNT)
    return joined.groupBy("farm_id").agg(
        carbon.alias("avg_carbon"),
        (agg.mean("ph_level", AMOUNT) * 0.5 + (100 - carbon * 0.2)).alias("score"),
    )


@query(
    "agg_wide_group",
    sql(
        f"""SELECT farm_id, crop_id, crop_type, year, month, farm_size_acres, expected_yield, sustainability_score,
        {mean('soil_moisture')} AS avg_moisture, COUNT(*) AS n FROM records GROUP BY farm_id, crop_id, crop_type,
        year, month, farm_size_acres, expected_yield, sustainability_score"""
    ),
)
def agg_wide_group(b: Binding) -> DataFrame:
    keys = [
        "farm_id", "crop_id", "crop_type", "year", "month", "farm_size_acres", "expected_yield",
        "sustainability_score",
    ]
    return b.records.groupBy(*keys).agg(
        agg.mean("soil_moisture", MEASURE).alias("avg_moisture"), F.count(F.lit(1)).alias("n")
    )


@query(
    "agg_derived_key",
    sql(
        f"""SELECT {season('month')} AS season, year, {mean('expected_yield * 0.9::DOUBLE')} AS avg_scaled
        FROM records GROUP BY 1, 2"""
    ),
)
def agg_derived_key(b: Binding) -> DataFrame:
    return (
        b.records.withColumn("season", scalar.season_of("month"))
        .groupBy("season", "year")
        .agg(agg.mean(F.col("expected_yield") * 0.9, AMOUNT).alias("avg_scaled"))
    )


# Ranks, changes, top rows


def farm_type_means(b: Binding) -> DataFrame:
    return b.records.groupBy("farm_id", "crop_type").agg(
        agg.mean("actual_yield", MEASURE).alias("avg_actual"),
        agg.mean("yield_percentage", MEASURE).alias("avg_percentage"),
    )


FARM_TYPE_MEANS = f"""SELECT farm_id, crop_type, {mean('actual_yield')} AS avg_actual,
    {mean('yield_percentage')} AS avg_percentage FROM records GROUP BY farm_id, crop_type"""
RANKS = [
    Rank("overall", "avg_percentage", ["farm_id", "crop_type"]),
    Rank("in_type", "avg_actual", ["farm_id"], within=["crop_type"]),
]
RANK_SQL = """ROW_NUMBER() OVER (ORDER BY avg_percentage DESC NULLS LAST, farm_id, crop_type) AS overall,
    ROW_NUMBER() OVER (PARTITION BY crop_type ORDER BY avg_actual DESC NULLS LAST, farm_id) AS in_type"""


@query("rank_windowed", sql(f"SELECT *, {RANK_SQL} FROM means", means=FARM_TYPE_MEANS))
def rank_windowed(b: Binding) -> DataFrame:
    return add_ranks(farm_type_means(b), RANKS)


@query("rank_distributed", sql(f"SELECT *, {RANK_SQL} FROM means", means=FARM_TYPE_MEANS))
def rank_distributed(b: Binding) -> DataFrame:
    return add_ranks(farm_type_means(b), RANKS)


@query(
    "rank_global",
    """SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rank
        FROM orders""",
)
def rank_global(b: Binding) -> DataFrame:
    orders = b.table("orders").select("o_orderkey", "o_totalprice")
    return add_ranks(orders, [Rank("rank", "o_totalprice", ["o_orderkey"])])


@query(
    "rank_in_type",
    """SELECT o_orderkey, o_orderpriority, o_totalprice, ROW_NUMBER() OVER (PARTITION BY o_orderpriority
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rank FROM orders""",
)
def rank_in_type(b: Binding) -> DataFrame:
    orders = b.table("orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    rank = Rank("rank", "o_totalprice", ["o_orderkey"], within=["o_orderpriority"])
    return add_ranks(orders, [rank])


@query(
    "lag_prev_year",
    sql(
        """SELECT farm_id, season, year, avg_actual, avg_actual - LAG(avg_actual, 1) OVER (PARTITION BY farm_id, season
        ORDER BY year) AS change FROM yearly""",
        yearly=f"""SELECT farm_id, {season('month')} AS season, year, {mean('actual_yield')} AS avg_actual
            FROM records GROUP BY 1, 2, 3""",
    ),
)
def lag_prev_year(b: Binding) -> DataFrame:
    yearly = (
        b.records.withColumn("season", scalar.season_of("month"))
        .groupBy("farm_id", "season", "year")
        .agg(agg.mean("actual_yield", MEASURE).alias("avg_actual"))
    )
    return change_from_previous(yearly, "avg_actual", ["farm_id", "season"], "year", "change")


@query(
    "topk_by_key",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100""",
)
def topk_by_key(b: Binding) -> DataFrame:
    """The capped table; the cap of 100 rows is the operator's own."""
    return joins.first_rows(b.table("orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100)
