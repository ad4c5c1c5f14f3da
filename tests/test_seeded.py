from datetime import date, datetime

import pytest

from martflow.bindings import agri
from martflow.bindings.testdata import Binding
from martflow.operators import joins
from martflow.plans import olap, seeded, staging, star
from tests.helpers import rows

AS_OF = datetime(2024, 6, 7, 8, 9)


@pytest.fixture(scope="module")
def seeds(spark):
    make = spark.createDataFrame
    return {
        "farm": make(
            [(1, "Hill", "North", 250, date(1990, 1, 2)), (2, "Vale", "South", 90, date(2001, 3, 4))],
            agri.seed_schema("seed_farm"),
        ),
        "crop": make(
            [
                (10, "corn", "grain", "Summer", "Medium"), (11, "wheat", "grain", "Winter", "Low"),
                (12, "plum", "fruit", "Annual", "High"), (13, "oat", "grain", "Monsoon", "Low"),
            ],
            agri.seed_schema("seed_crop"),
        ),
        "harvest": make(
            [
                (100, 1, 10, date(2023, 9, 1), 400, "A"), (101, 1, 11, date(2023, 7, 1), 0, "B"),
                (102, 2, 12, None, 50, "C"),
            ],
            agri.seed_schema("seed_harvest"),
        ),
        "yield": make(
            [(1, 1, 10, 100, 3.0, 2023), (2, 1, 11, 101, 2.0, 2022), (3, 2, 12, 102, 1.0, 2023),
             (4, 2, 13, None, 4.0, 2021)],
            agri.seed_schema("seed_yield"),
        ),
        "sustainability": make([(1, 1, None, 45, 15, 60)], agri.seed_schema("seed_sustainability")),
        "soil": make([(1, 1, 6.0, "x", "y", 2.0)], agri.seed_schema("seed_soil")),
    }


def test_season_dates(seeds):
    found = rows(seeded.season_dates(seeds["yield"], seeds["crop"]))
    assert found == [
        (1, 10, 2023, date(2023, 6, 15), date(2023, 9, 15)),
        (1, 11, 2022, date(2022, 11, 15), date(2022, 2, 15)),
        (2, 12, 2023, date(2023, 4, 1), date(2023, 10, 1)),
        (2, 13, 2021, date(2021, 5, 1), date(2021, 9, 1)),
    ]
    wrapped = seeded.season_dates(seeds["yield"], seeds["crop"], wrap_year=True).where("crop_id = 11").first()
    assert wrapped.harvest_date == date(2023, 2, 15)


def test_full_data(seeds):
    df = seeded.full_data(seeds, AS_OF)
    assert sorted(df.columns) == sorted(agri.CONTRACTS["full_data"])
    found = {r.Crop_ID: r for r in df.collect()}
    corn, oat = found["10"], found["13"]
    assert (corn.Farm_Type, corn.Expected_Yield, corn.Actual_Yield) == ("grain", 400, pytest.approx(360))
    assert (corn.Soil_Moisture, corn.Soil_Temperature, corn.Sustainability_Score) == (60.0, 70.0, 85)
    assert (corn.Soil_Fertility, corn.Pesticide_Type, corn.Equipment_Used) == ("Medium", "Chemical", "Heavy Machinery")
    assert (corn.Quality_Grade, corn.Certification, corn.Total_Revenue) == ("A", "Organic", 4000)
    assert (corn.Irrigation_Amount, corn.Water_Footprint, corn.Labor_Hours) == (450, 4500, 500)
    assert (oat.Expected_Yield, oat.Actual_Yield, oat.Total_Revenue) == (None, None, None)
    assert (oat.Soil_Moisture, oat.Soil_Temperature, oat.Soil_pH) == (60.0, 55.0, 6.5)
    assert (oat.Sustainability_Score, oat.Carbon_Footprint, oat.Water_Footprint) == (75, 50, 300)
    assert (oat.Soil_Fertility, oat.Pesticide_Type, oat.Pesticide_Amount) == ("Low", "Organic", 30)
    assert (oat.Equipment_Used, oat.Quality_Grade, oat.year, oat.month) == ("Manual Tools", "B", 2021, 5)


def test_staged_full_data(seeds):
    df = seeded.staged_full_data(seeds, AS_OF)
    found = {r.crop_id: r for r in df.collect()}
    corn, wheat, oat = found["10"], found["11"], found["13"]
    assert 200 <= corn.actual_yield < 480
    assert corn.yield_percentage == pytest.approx(corn.actual_yield / 400 * 100)
    assert (wheat.actual_yield, wheat.yield_percentage, wheat.growing_period_days) == (100.0, None, -273)
    assert (oat.actual_yield, oat.yield_percentage, oat.established_year) == (100.0, None, 2001)
    again = {r.crop_id: r for r in seeded.staged_full_data(seeds, AS_OF).repartition(7).collect()}
    assert again == found


def test_several_yields_of_a_harvest_repeat_its_record(spark, seeds):
    more = seeds["yield"].union(
        spark.createDataFrame([(9, 7, 10, 100, 3.0, 2023)], seeds["yield"].schema)
    )
    doubled = dict(seeds, **{"yield": more})
    count = {r.crop_id: r["count"] for r in seeded.seed_records(doubled).groupBy("crop_id").count().collect()}
    assert count == {10: 2, 11: 1, 12: 1, 13: 1}
    assert seeded.seed_records(doubled, fanout="none").count() == 4


def test_rollups_from_seeds(spark, seeds):
    assert rows(seeded.farm_analysis(seeds["farm"], seeds["soil"])) == [
        (1, "Mixed", 250, 60.0, 70.0), (2, "Mixed", 90, 60.0, 55.0),
    ]
    assert ("grain", "oat", 100, 90, 90) in rows(seeded.crop_analysis_constant(seeds["crop"]))
    averaged = {r.Crop_Variety: r for r in seeded.crop_analysis_from_harvest(seeds["crop"], seeds["harvest"]).collect()}
    assert averaged["corn"].avg_Actual_Yield == pytest.approx(360) and averaged["oat"].avg_Expected_Yield is None
    assert (averaged["plum"].avg_Growing_Period_Days, averaged["wheat"].avg_Growing_Period_Days) == (365, 120)


def test_fallback(seeds):
    assert seeded.fallback_farm_analysis(seeds["farm"]).columns == agri.CONTRACTS["farm_analysis"]
    assert seeded.fallback_crop_analysis(seeds["crop"]).columns == agri.CONTRACTS["crop_analysis"]


def test_staging(spark, seeds):
    full = staging.stage_full_data(seeded.full_data(seeds, AS_OF), AS_OF)
    corn = full.where("crop_id = '10'").first()
    assert (corn.planting_month, corn.growing_period_days) == (date(2023, 6, 1), 92)
    assert corn.yield_percentage == pytest.approx(90) and corn.loaded_at == AS_OF
    assert full.where("crop_id = '11'").first().yield_percentage is None
    crop = staging.stage_seed(seeds["crop"], "stg_crop", AS_OF)
    assert crop.columns == [*staging.SEED_COLUMNS["stg_crop"], "loaded_at"]
    moved = staging.season_year(full, "harvest_date").where("crop_id = '10'").first()
    assert (moved.year, moved.month) == (2023, 9)


def test_star_and_rollups_from_records(spark, path):
    schema = agri.record_schema()
    given = [
        {"Farm_ID": "F1", "Crop_ID": "C1", "Farm_Type": "Crop", "Farm_Size_Acres": 10.0, "Soil_Moisture": 1.0,
         "Planting_Date": "2024-01-10", "Harvest_Date": "2024-01-05", "timestamp": "2024-02-03T04:05:06"},
        {"Farm_ID": "F1", "Crop_ID": "C1", "Farm_Type": "Crop", "Farm_Size_Acres": 20.0, "Soil_Moisture": 3.0,
         "Planting_Date": "bad", "Harvest_Date": "2024-01-05", "timestamp": "2024-03-03T04:05:06"},
    ]
    records = spark.createDataFrame([tuple(g.get(n) for n in schema.names) for g in given], schema)
    written = star.write_star(records, path("star"))
    assert len(written) == 10
    assert spark.read.parquet(written["dim_farm"]).count() == 2
    assert spark.read.parquet(written["dim_crop"]).count() == 1
    fact = rows(spark.read.parquet(written["fact_farm_production"]), "Planting_Year", "Growth_Period_Days")
    assert fact == [(2024, -5), (None, None)]
    latest = star.dimension(star.conformed(records), "farm", ["Farm_ID"])
    assert latest.count() == 1 and latest.first().Farm_Size_Acres == 20.0
    streamed = records.selectExpr("*", "cast(null as int) as Growing_Period_Days")
    tables = olap.write_olap(streamed, path("olap"))
    analysis = spark.read.parquet(tables["farm_analysis"]).first()
    assert analysis.asDict() == {
        "Farm_ID": "F1", "Farm_Type": "Crop", "avg_Farm_Size_Acres": 15.0, "avg_Soil_Moisture": 2.0,
        "avg_Soil_Temperature": None,
    }
    assert spark.read.parquet(tables["crop_analysis"]).columns == agri.CONTRACTS["crop_analysis"]
    assert rows(spark.read.parquet(tables["full_data"]), "year", "month") == [(2024, 2), (2024, 3)]


@pytest.fixture
def ordered(spark, path):
    """Orders of three crops, with repeated and null keys, as the given tables name them."""
    tables = {
        "lineitem": (
            [
                (o, p, s, n, q, 10.0 * n, 0.05, 0.02, "A", "F", datetime(2024, 3, n))
                for n, (o, p, s, q) in enumerate(
                    [(1, 10, 1, 5.0), (1, 10, 1, 5.0), (1, 11, 2, None), (2, 12, 1, 7.0), (2, None, 1, 8.0), (None, 10, 2, 9.0),
                     (3, 12, None, 1.0), (3, 13, 2, 2.0), (3, 10, 2, 4.0)], 1)
            ],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
        "orders": (
            [(1, "O", datetime(2024, 1, 5, 13)), (2, "F", None), (2, "O", datetime(2024, 1, 6)), (3, None, datetime(2023, 1, 6))],
            "o_orderkey long, o_orderstatus string, o_orderdate timestamp",
        ),
        "part": (
            [(10, "corn", "B1", 3, 1.0), (11, None, "B2", None, 2.0), (12, "oat", "B3", 4, None), (12, "oat", "B3", 4, None),
             (None, "rye", "B4", 5, 3.0)],
            "p_partkey long, p_type string, p_brand string, p_size int, p_retailprice double",
        ),
        "supplier": (
            [(1, "S1", 3, 10.0), (2, None, None, None), (None, "S3", 1, 1.0)],
            "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
        ),
    }
    for name, (given, schema) in tables.items():
        spark.createDataFrame(given, schema).write.parquet(f"{path('given')}/{name}.parquet")
    return Binding(spark, path("given"))


def test_stored_records_are_not_shuffled_for_the_crop(spark, ordered, path):
    entries = spark.catalog.listTables()
    stored = ordered.stored_raw()
    assert stored.count() == 8 and rows(stored) == rows(ordered.raw)
    assert stored.columns == ordered.raw.columns and spark.catalog.listTables() == entries
    for name, found in star.dimensions(star.conformed(stored)).items():
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange" in plan) == ("Crop_ID" not in agri.DIMENSIONS[name]), name
    written = star.write_star(stored, path("star"))
    shaped = star.conformed(ordered.raw)
    tables = {f"dim_{n}": df for n, df in star.dimensions(shaped).items()}
    tables |= {f"fact_{n}": df for n, df in star.facts(shaped).items()}
    assert written.keys() == tables.keys()
    for name, expected in tables.items():
        assert rows(spark.read.parquet(written[name])) == rows(expected), name


def test_records_of_a_hot_crop_stay_as_they_are(ordered, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 0)
    monkeypatch.setattr(joins, "HOT_TIMES", 1)
    stored = ordered.stored_raw()
    assert "Bucketed: true" not in star.dimension(stored, "crop")._jdf.queryExecution().executedPlan().toString()
    assert rows(stored) == rows(ordered.raw)


@pytest.mark.parametrize("name", ["write_star", "write_star_fact"])
def test_star_queries_shuffle_no_records_for_the_crop(spark, ordered, monkeypatch, name):
    from martflow.workload import lake, supply  # noqa: F401
    from martflow.workload.registry import QUERIES

    given, write = [], star.write_star
    monkeypatch.setattr(star, "write_star", lambda records, prefix: given.append(records) or write(records, prefix))
    found = rows(QUERIES[name](spark, ordered.directory))
    if name == "write_star":
        assert dict(found) == {
            "dim_crop": 3, "dim_farm": 2, "fact_crop_yield": 8, "fact_farm_production": 8, "fact_sustainability": 8
        }
    else:
        assert found == rows(star.production_fact(star.conformed(ordered.raw)))
    plan = star.dimension(given[0], "financial")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
