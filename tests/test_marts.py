"""The marts against nested loops over small tables with several rows per key on every side."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from martflow.functions import aggregate as agg
from martflow.functions.aggregate import FixedPoint
from martflow.operators.fanout import Side, join_condensed, product_mean
from martflow.plans import marts
from tests.helpers import assert_same, mean, rows

FARMS = [(1, "Hill", "North", 100.0), (2, "Vale", "South", 0.0), (3, "Moor", "West", 64.0)]
CROPS = [
    (10, "corn", "grain", "Summer", "Low"), (11, "corn", "grain", "Summer", "Low"),
    (12, "rice", "grain", "Fall", "Very High"), (13, "pea", "legume", "Spring", "Odd"),
    (14, "kale", "leaf", "Winter", "High"),
]
# farm, crop, type, size, planting day, expected, actual, moisture, temperature, score, year, month, days
RECORDS = [
    (1, "10", "grain", 100.0, "2022-07-01", 10.0, 7.0, 1.0, 9.0, 80.0, 2022, 7, 30),
    (1, "10", "grain", 100.0, "2023-07-02", 10.0, 9.5, 2.0, 8.0, 60.0, 2023, 7, -4),
    (1, "12", "grain", 100.0, "2023-12-03", 20.0, 5.0, 3.0, None, 59.0, 2023, 12, 60),
    (1, "13", "legume", 100.0, "2023-03-04", 0.0, 100.0, 4.0, 6.0, None, 2023, 3, 10),
    (2, "13", "legume", 0.0, "2021-10-05", 8.0, 8.0, 5.0, 5.0, 20.0, 2021, 10, None),
    (2, "CROP_9", None, 0.0, "2023-01-06", 8.0, 4.0, 6.0, 4.0, 10.0, 2023, 1, 12),
    (4, "10", "grain", 50.0, "2023-05-07", 4.0, 3.0, 7.0, 3.0, 45.0, 2023, 5, 13),
]
SOIL = [(1, 6.5, 2.0), (1, 7.0, None), (2, 5.5, 4.0)]
USE = [(1, 30, 50, 10), (1, None, 70, 20), (1, 20, 0, None), (3, 5, 6, 7)]
YIELDS = [(1, 10, 2.0), (1, 10, 3.0), (1, 11, None), (2, 13, 4.0), (2, 12, 1.0)]
PRODUCTION = [(10, 5.0, 10.0), (10, 6.0, 0.0), (11, 7.0, 20.0), (13, 8.0, None)]
HARVEST = [(10, 1.0), (10, 2.0), (10, None), (11, 9.0), (11, 4.0), (12, 3.0)]
WEATHER = [(20, 1, 50), (30, None, 60)]

RECORD_NAMES = (
    "farm_id crop_id crop_type farm_size_acres planting_date expected_yield actual_yield soil_moisture "
    "soil_temperature sustainability_score year month growing_period_days"
).split()


def record_dicts():
    found = []
    for values in RECORDS:
        r = dict(zip(RECORD_NAMES, values))
        r["yield_percentage"] = r["actual_yield"] / r["expected_yield"] * 100 if r["expected_yield"] else None
        found.append(r)
    return found


@pytest.fixture(scope="module")
def tables(spark):
    records = spark.createDataFrame(
        [tuple(r.values()) for r in record_dicts()],
        "farm_id long, crop_id string, crop_type string, farm_size_acres double, planting_date string, "
        "expected_yield double, actual_yield double, soil_moisture double, soil_temperature double, "
        "sustainability_score double, year int, month int, growing_period_days int, yield_percentage double",
    )
    make = spark.createDataFrame
    return {
        "farms": make(FARMS, "farm_id long, farm_name string, farm_location string, farm_size double"),
        "crops": make(
            CROPS, "crop_id long, crop_name string, crop_type string, growing_season string, water_needs string"
        ),
        "records": records.withColumn("planting_date", records.planting_date.cast("date")),
        "soil": make(SOIL, "farm_id long, ph_level double, organic_matter double"),
        "use": make(USE, "farm_id long, water_usage long, carbon_footprint long, pesticide_usage long"),
        "yields": make(YIELDS, "farm_id long, crop_id long, yield_per_hectare double"),
        "production": make(PRODUCTION, "crop_id long, quantity_produced double, cost double"),
        "harvest": make(HARVEST, "crop_id long, yield_amount double"),
        "weather": make(WEATHER, "temperature int, precipitation int, humidity int"),
    }


def matches(rows, key, position=0):
    return [r for r in rows if r[position] == key] or [None]


def part(row, position):
    return None if row is None else row[position]


def farm_brute_force(farms=FARMS):
    groups = {}
    for (farm, *_), named in product(farms, farms):
        if farm != named[0]:
            continue
        own = [r for r in record_dicts() if r["farm_id"] == farm] or [None]
        for r, s, u, y in product(own, matches(SOIL, farm), matches(USE, farm), matches(YIELDS, farm)):
            key = (*named, r["crop_type"] if r else None)
            groups.setdefault(key, []).append((r or dict.fromkeys([*RECORD_NAMES, "yield_percentage"]), s, u, y))
    found = []
    for (farm, name, place, size, kind), rows in groups.items():
        def of(column):
            return [r[column] for r, *_ in rows]

        water = mean([part(u, 1) or 0 for _, _, u, _ in rows])
        carbon = mean([part(u, 2) or 0 for _, _, u, _ in rows])
        percent, score = mean(of("yield_percentage")), mean(of("sustainability_score"))
        actual = [v for v in of("actual_yield") if v is not None]
        found.append(
            {
                "farm_id": farm, "farm_name": name, "farm_location": place, "avg_farm_size_acres": size,
                "farm_type": kind,
                "avg_soil_moisture": mean(of("soil_moisture")), "avg_soil_temperature": mean(of("soil_temperature")),
                "avg_soil_ph": mean([part(s, 1) for _, s, _, _ in rows]),
                "avg_organic_matter": mean([part(s, 2) for _, s, _, _ in rows]),
                "avg_water_usage": mean([part(u, 1) for _, _, u, _ in rows]),
                "avg_carbon_footprint": mean([part(u, 2) for _, _, u, _ in rows]),
                "avg_pesticide_usage": mean([part(u, 3) for _, _, u, _ in rows]),
                "avg_yield_per_hectare": mean([part(y, 2) for _, _, _, y in rows]),
                "avg_actual_yield": mean(actual), "total_actual_yield": sum(actual) if actual else None,
                "avg_yield_percentage": percent, "avg_sustainability_score": score,
                "recent_avg_yield": mean([r["actual_yield"] for r, *_ in rows if r["year"] and r["year"] >= 2023]),
                "avg_growing_period": mean(of("growing_period_days")),
                "yield_per_acre": mean(
                    [r["actual_yield"] / r["farm_size_acres"] for r, *_ in rows if r["farm_size_acres"]]
                ),
                "farm_performance_score": None if percent is None or score is None else
                percent * 0.4 + score * 0.3 + (100 - water * 0.1) + (100 - carbon * 0.2),
            }
        )
    return found


def by_key(rows, *names):
    return sorted(rows, key=lambda r: [(r[n] is None, str(r[n])) for n in names])


@pytest.mark.parametrize("exact", [None, FixedPoint(), FixedPoint("decimal(18,4)", "decimal(28,10)", "decimal(18,6)")])
def test_farm_performance(tables, exact):
    found = marts.farm_performance(
        tables["farms"], tables["records"], tables["soil"], tables["use"], tables["yields"], 2024, exact,
    ).collect()
    expected = farm_brute_force()
    tolerant = [{k: round(v, 3) if isinstance(v, float) else v for k, v in row.items()} for row in expected]
    rounded = [
        {k: round(v, 3) if isinstance(v, float) else v for k, v in r.asDict().items()} for r in found
    ]
    assert_same(by_key(rounded, "farm_id", "farm_type"), by_key(tolerant, "farm_id", "farm_type"))
    ranked = sorted(found, key=lambda r: r["yield_rank"])
    assert [r["yield_rank"] for r in ranked] == list(range(1, len(found) + 1))
    values = [r["avg_yield_percentage"] for r in ranked]
    known = [v for v in values if v is not None]
    assert known == sorted(known, reverse=True) and values[: len(known)] == known
    inside = [r["yield_rank_in_type"] for r in found if r["farm_type"] == "grain"]
    assert sorted(inside) == list(range(1, len(inside) + 1))


def test_farm_performance_with_repeated_farms(spark, tables):
    repeated = FARMS + [FARMS[0], (2, "Vale", "East", 0.0)]
    farms = spark.createDataFrame(repeated, tables["farms"].schema)
    found = marts.farm_performance(
        farms, tables["records"], tables["soil"], tables["use"], tables["yields"], 2024
    ).collect()
    names = ("farm_id", "farm_location", "farm_type")
    assert_same(by_key(found, *names), by_key(farm_brute_force(repeated), *names))


def test_farm_performance_without_fanout(tables):
    found = marts.farm_performance(
        tables["farms"], tables["records"], tables["soil"], tables["use"], tables["yields"], 2024, fanout="none"
    )
    total = {(r.farm_id, r.farm_type): r.total_actual_yield for r in found.collect()}
    assert total[(1, "grain")] == pytest.approx(21.5) and total[(3, None)] is None


def crop_brute_force(crops=CROPS):
    groups = {}
    records = record_dicts()
    for base, named in product(crops, crops):
        if base[0] != named[0]:
            continue
        own = [r for r in records if r["crop_type"] == base[2]] or [None]
        sides = product(own, matches(YIELDS, named[0], 1), matches(PRODUCTION, named[0]), matches(HARVEST, named[0]))
        key = (base[2], base[1], named[1], named[3], named[4])
        groups.setdefault(key, []).extend(sides)
    found = []
    for (kind, variety, name, season, needs), rows in groups.items():
        def of(column, keep=lambda r: True):
            return mean([r[column] for r, *_ in rows if r and keep(r)])

        expected, actual, percent = of("expected_yield"), of("actual_yield"), of("yield_percentage")
        efficiency = mean([p[1] / p[2] for _, _, p, _ in rows if p and p[2]])
        per_hectare = mean([part(y, 2) for _, y, _, _ in rows])
        this, last = (of("actual_yield", lambda r, y=y: r["year"] == y) for y in (2023, 2022))
        found.append(
            {
                "crop_type": kind, "crop_variety": variety, "crop_name": name, "growing_season": season,
                "water_needs": needs, "avg_expected_yield": expected, "avg_actual_yield": actual,
                "avg_growing_period_days": of("growing_period_days"),
                "yield_efficiency_pct": actual / expected * 100 if expected else None,
                "avg_yield_per_hectare": per_hectare,
                "avg_quantity_produced": mean([part(p, 1) for _, _, p, _ in rows]),
                "avg_production_cost": mean([part(p, 2) for _, _, p, _ in rows]),
                "production_efficiency": efficiency,
                "avg_harvest_yield": mean([part(h, 1) for *_, h in rows]),
                "farm_count": len({r["farm_id"] for r, *_ in rows if r}),
                "avg_sustainability_score": of("sustainability_score"),
                "current_year_yield": this, "previous_year_yield": last,
                "yoy_growth_pct": (this / last - 1) * 100 if this is not None and last else None,
                "spring_yield": of("actual_yield", lambda r: r["month"] in (3, 4, 5)),
                "summer_yield": of("actual_yield", lambda r: r["month"] in (6, 7, 8)),
                "fall_yield": of("actual_yield", lambda r: r["month"] in (9, 10, 11)),
                "winter_yield": of("actual_yield", lambda r: r["month"] in (12, 1, 2)),
                "avg_yield_percentage": percent,
                "crop_performance_score": None if None in (percent, efficiency, per_hectare) else
                percent * 0.5 + efficiency / 10 * 0.3 + per_hectare / 5 * 0.2,
            }
        )
    return found


def crop_mart(tables, crops, **options):
    return marts.crop_performance(
        crops, tables["records"], tables["yields"], tables["production"], tables["harvest"], 2023, **options
    )


@pytest.mark.parametrize("exact", [None, FixedPoint()])
def test_crop_performance(tables, exact):
    found = crop_mart(tables, tables["crops"], exact=exact).collect()
    names = ("crop_type", "crop_name", "growing_season")
    expected = crop_brute_force()
    if exact is None:
        assert_same(by_key(found, *names), by_key(expected, *names))
    else:
        for f, e in zip(by_key(found, *names), by_key(expected, *names)):
            for key, value in e.items():
                assert f[key] == (pytest.approx(value, abs=1e-3) if isinstance(value, float) else value), key
    assert sorted(r["yield_efficiency_rank"] for r in found) == list(range(1, len(found) + 1))


def test_crop_performance_with_repeated_crops(spark, tables):
    repeated = CROPS + [CROPS[0], (12, "basmati", "grain", "Fall", "High")]
    crops = spark.createDataFrame(repeated, tables["crops"].schema)
    names = ("crop_type", "crop_variety", "crop_name", "growing_season", "water_needs")
    assert_same(by_key(crop_mart(tables, crops).collect(), *names), by_key(crop_brute_force(repeated), *names))


def test_crop_performance_without_fanout(tables):
    found = {(r.crop_name, r.growing_season): r for r in crop_mart(tables, tables["crops"], fanout="none").collect()}
    assert found[("corn", "Summer")].avg_quantity_produced == pytest.approx(6.0)
    assert found[("corn", "Summer")].avg_harvest_yield == pytest.approx(4.0)


def test_product_mean_equals_the_product(spark):
    left = spark.createDataFrame([(1, 2.0), (1, None), (2, 5.0), (3, 1.0)], "k int, x double")
    right = spark.createDataFrame([(1, 7.0), (1, 8.0), (1, 9.0), (3, None)], "k int, y double")
    base = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k int")
    sides = [Side("l", left, "k", {"x": (left.x, None)}), Side("r", right, "k", {"y": (right.y, None)})]
    met = [s.name for s in sides]
    row = join_condensed(base, sides).agg(
        product_mean(sides[0], met, "x").alias("x"), product_mean(sides[1], met, "y").alias("y")
    ).first()
    joined = base.join(left, "k", "left").join(right, "k", "left").selectExpr("avg(x)", "avg(y)").first()
    assert tuple(row) == pytest.approx(tuple(joined))


def test_seasonal_performance(tables):
    found = marts.seasonal_performance(tables["records"], tables["farms"], tables["crops"], tables["weather"])
    rows = {(r.farm_id, r.crop_id, r.year, r.season): r for r in found.collect()}
    assert len(rows) == 7
    first, second = rows[(1, "10", 2022, "Summer")], rows[(1, "10", 2023, "Summer")]
    assert first.yield_change_from_previous_year is None
    assert second.yield_change_from_previous_year == pytest.approx(2.5)
    assert (first.season_recommendations, first.season_performance_rating) == (marts.RECOMMEND_SUMMER, 2)
    assert (second.season_recommendations, second.season_performance_rating) == (marts.RECOMMEND_NOTHING, 5)
    assert rows[(1, "12", 2023, "Winter")].season_recommendations == marts.RECOMMEND_WINTER
    assert rows[(1, "13", 2023, "Spring")].season_performance_rating == 1
    unknown = rows[(2, "CROP_9", 2023, "Winter")]
    assert (unknown.crop_name, unknown.farm_name) == (None, "Vale")
    assert rows[(4, "10", 2023, "Spring")].farm_name is None
    assert all((r.avg_temperature, r.avg_precipitation, r.avg_humidity) == (25.0, 1.0, 55.0) for r in rows.values())


def test_sustainability_metrics(tables):
    found = marts.sustainability_metrics(
        tables["records"], tables["farms"], tables["use"], tables["soil"], tables["crops"], tables["weather"]
    ).collect()
    expected = []
    for r in record_dicts():
        if r["sustainability_score"] is None:
            continue
        for u, s in product(matches(USE, r["farm_id"]), matches(SOIL, r["farm_id"])):
            water, carbon, pesticide = (part(u, i) for i in (1, 2, 3))
            score, actual, size = r["sustainability_score"], r["actual_yield"], r["farm_size_acres"]
            expected.append(
                {
                    "farm_id": r["farm_id"], "crop_id": r["crop_id"], "sustainability_score": score,
                    "water_usage": water, "carbon_footprint": carbon, "pesticide_usage": pesticide,
                    "ph_level": part(s, 1), "organic_matter": part(s, 2),
                    "comprehensive_sustainability_score": score * 0.4 + (100 - (water or 0)) * 0.2
                    + (100 - (carbon or 0)) * 0.2 + (100 - (pesticide or 0)) * 0.2,
                    "avg_soil_moisture": r["soil_moisture"], "avg_soil_temperature": r["soil_temperature"],
                    "water_efficiency": actual / water if water else None,
                    "carbon_efficiency": actual / carbon if carbon else None,
                    "yield_density": actual / size if size else None,
                    "size_normalized_score": score / size**0.5 if size else None,
                    "yield_normalized_score": score / actual if actual else None,
                    "avg_precipitation": 1.0, "avg_humidity": 55.0,
                }
            )
    names = ("farm_id", "crop_id", "sustainability_score", "water_usage", "carbon_footprint", "ph_level")
    assert_same(by_key(found, *names), by_key(expected, *names))
    tiers = {r["sustainability_score"]: r["sustainability_tier"] for r in found}
    assert tiers == {80.0: 5, 60.0: 4, 59.0: 3, 20.0: 2, 10.0: 1, 45.0: 3}
    single = marts.sustainability_metrics(
        tables["records"], tables["farms"], tables["use"], tables["soil"], tables["crops"], tables["weather"],
        fanout="none",
    )
    assert single.count() == 6


def test_all_marts_keep_their_contracts(spark, tables, path):
    from datetime import datetime

    from martflow.bindings import agri
    from martflow.operators.quality import contract_report
    from martflow.sinks.files import write_tables

    staged = {
        "stg_farm": tables["farms"], "stg_crop": tables["crops"], "stg_weather": tables["weather"],
        "stg_soil": tables["soil"], "stg_sustainability": tables["use"], "stg_yield": tables["yields"],
        "stg_production": tables["production"], "stg_harvest": tables["harvest"],
    }
    as_of = datetime(2023, 6, 1, 12)
    found = marts.all_marts(tables["records"], staged, as_of)
    assert {name: mart.columns for name, mart in found.items()} == agri.MARTS
    for name, mart in found.items():
        assert contract_report(mart, agri.MARTS[name]).where("status <> 'ok'").count() == 0
    for name, written in write_tables(found, path("marts")).items():
        rows = spark.read.parquet(written)
        assert rows.count() > 0 and rows.where("generated_at <> timestamp'2023-06-01 12:00:00'").count() == 0


def test_farm_without_an_id_stays(spark, tables):
    nameless = spark.createDataFrame([(None, "none", "nowhere", 1.0)], tables["farms"].schema)
    marts_rows = marts.farm_performance(
        tables["farms"].unionByName(nameless), tables["records"], tables["soil"], tables["use"], tables["yields"], 2024
    ).collect()
    assert [r.farm_name for r in marts_rows if r.farm_id is None] == ["none"]


def test_records_are_shuffled_once_where_crops_are_even(spark, tables):
    """For groups, changes and joins alike, and with the same rows as where each of them shuffles."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t = tables
        for build in (
            lambda even: marts.seasonal_performance(t["records"], t["farms"], t["crops"], t["weather"], even_crops=even),
            lambda even: marts.sustainability_metrics(
                t["records"], t["farms"], t["use"], t["soil"], t["crops"], t["weather"], even_crops=even
            ),
        ):
            told = build(True)._jdf.queryExecution().executedPlan().toString()
            assert sum("Exchange hash" in line and "_crop_key" in line for line in told.splitlines()) == 1, told
            assert rows(build(True)) == rows(build(False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_counted_ids_travel_without_the_sums(spark):
    """The ids are shuffled on rows of their own, so the sums are combined before."""
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.expr("if(id % 5 = 0, null, id % 7)").alias("v"), "id")
    found = df.groupBy("k").agg(F.sum("id"), agg.distinct_count("v", apart=True))
    assert "Expand" in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(df.groupBy("k").agg(F.sum("id"), agg.distinct_count("v")))
