from datetime import date

from pyspark.sql import functions as F

from martflow.functions import scalar
from martflow.plans import marts, seeded


def evaluate(spark, column, schema, *values):
    df = spark.createDataFrame([tuple(v if isinstance(v, tuple) else (v,)) for v in values], schema)
    return [r[0] for r in df.select(column).collect()]


def test_value_map_sends_unknown_and_null_to_otherwise(spark):
    found = evaluate(spark, seeded.growing_days("s"), "s string", "Annual", "Fall", "Monsoon", None)
    assert found == [365, 80, 90, 90]


def test_bands_at_their_limits(spark):
    strict = scalar.band("x", *seeded.GRADE)
    assert evaluate(spark, strict, "x double", 80.0, 80.1, 60.0, 41.0, 0.0, None) == ["B", "A", "C", "C", "D", "D"]
    inclusive = scalar.band("x", *marts.SUSTAINABILITY_TIERS, inclusive=True)
    assert evaluate(spark, inclusive, "x double", 80.0, 79.9, 20.0, 19.0, None) == [5, 4, 2, 1, 1]


def test_season_advice(spark):
    advice = marts.season_advice("p", "s")
    found = evaluate(
        spark, advice, "p double, s string", (79.0, "Summer"), (10.0, "Winter"), (10.0, "Fall"), (80.0, "Summer"),
        (None, "Winter"),
    )
    assert found == [
        marts.RECOMMEND_SUMMER, marts.RECOMMEND_WINTER, marts.RECOMMEND_REVIEW, marts.RECOMMEND_NOTHING,
        marts.RECOMMEND_NOTHING,
    ]


def test_ratios_of_zero_and_null(spark):
    ratio = scalar.safe_ratio("a", "b")
    assert evaluate(spark, ratio, "a double, b double", (1.0, 4.0), (1.0, 0.0), (None, 2.0), (1.0, None)) == [
        0.25, None, None, None,
    ]
    assert evaluate(spark, scalar.percent_of("a", "b"), "a long, b long", (9, 10), (9, 0)) == [90.0, None]
    assert evaluate(spark, scalar.growth_percent("a", "b"), "a double, b double", (3.0, 2.0), (3.0, 0.0)) == [50.0, None]


def test_root_of_unusable_sizes(spark):
    assert evaluate(spark, scalar.per_root("a", "b"), "a double, b double", (6.0, 9.0), (6.0, 0.0), (6.0, -1.0)) == [
        2.0, None, None,
    ]


def test_seasons(spark):
    found = evaluate(spark, scalar.season_of("m"), "m int", *range(1, 13))
    assert found == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]


def test_dates(spark):
    texts = ["2024-02-29", "2024-13-01", "nonsense", None]
    assert evaluate(spark, scalar.parse_date("d"), "d string", *texts) == [date(2024, 2, 29), None, None, None]
    found = evaluate(spark, scalar.iso_date("d"), "d string", "2024-05-06T07:08:09.123456", "x")
    assert found == [date(2024, 5, 6), None]
    assert evaluate(spark, scalar.month_floor("d"), "d date", date(2024, 5, 6)) == [date(2024, 5, 1)]
    between = scalar.days_between("a", "b")
    assert evaluate(spark, between, "a date, b date", (date(2023, 11, 15), date(2023, 2, 15))) == [-273]
    shifted = scalar.shifted_date_text("d", 3)
    assert evaluate(spark, shifted, "d date", date(2024, 2, 27)) == ["2024-03-01"]


def test_ids_from_text(spark):
    assert evaluate(spark, scalar.as_id("k"), "k string", "17", "CROP_17", "", None) == [17, None, None, None]


def test_profit_margin_rounds_half_up(spark):
    margin = scalar.profit_margin("r", "c")
    found = evaluate(spark, margin, "r double, c double", (200.0, 150.0), (0.0, 10.0), (3.0, 1.0), (1.0, 3.0))
    assert found == [25.0, None, 66.67, -200.0]


def test_noise_is_stable_and_spread(spark):
    df = spark.range(10_000).withColumn("u", scalar.stable_noise("id", F.lit(7)))
    once = [r.u for r in df.orderBy("id").collect()]
    again = [r.u for r in df.repartition(13).orderBy("id").collect()]
    assert once == again
    assert 0 <= min(once) and max(once) < 1
    assert abs(sum(once) / len(once) - 0.5) < 0.02


def test_noise_takes_any_key(spark):
    keys = [0, -5, 2**62, -(2**62), None]
    found = evaluate(spark, scalar.stable_noise("k"), "k long", *keys)
    assert found[-1] is None and all(0 <= u < 1 for u in found[:-1])


def test_locations(spark):
    df = spark.createDataFrame([(1.23456, -7.0)], "a double, b double").select(
        scalar.lat_lon_text("a", "b").alias("t")
    )
    row = df.select("t", scalar.lat_of("t"), scalar.lon_of("t")).first()
    assert tuple(row) == ("1.2346,-7.0000", 1.2346, -7.0)


def test_table_of_path(spark):
    paths = ["s3://lake/olap/full_data/year=2024/month=5/part-0.parquet", "/data/farm/part-1.parquet"]
    assert evaluate(spark, scalar.table_of_path("p"), "p string", *paths) == ["full_data", "farm"]


def test_content_id_depends_on_content_only(spark):
    ids = evaluate(spark, scalar.content_id("a", "b"), "a int, b string", (1, "x"), (1, "x"), (2, "x"))
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64


def test_classification(spark):
    found = evaluate(spark, scalar.irrigation_efficiency("m"), "m string", "Drip", "Flood", "Sprinkler", None)
    assert found == ["High", "Low", None, None]
    plausible = scalar.ph_plausible("s", "p")
    found = evaluate(spark, plausible, "s string, p double", ("Peaty", 4.0), ("Peaty", 7.0), ("Other", 7.5))
    assert found == [True, False, True]


def test_exact_sums_agree(spark):
    import random

    from martflow.functions import aggregate as agg

    draw = random.Random(3)
    values = [draw.uniform(-500, 500) for _ in range(2000)] + [None, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    wanted = sum(v for v in values if v is not None)
    for exact in (None, 4, 5, 8, 10, "decimal(18,4)", "decimal(28,10)"):
        spread = [
            df.repartition(n).agg(agg.total("x", exact).alias("t"), agg.mean("x", exact).alias("m")).first()
            for n in (1, 7, 40)
        ]
        assert all(abs(r.t - wanted) < 0.1 and abs(r.m - wanted / 2001) < 1e-4 for r in spread)
        if exact is not None:
            assert len({tuple(r) for r in spread}) == 1
    assert agg.widest(10) == agg.widest("decimal(28,10)") == "decimal(38,10)"
    empty = df.where("x is null").agg(agg.total("x", 10).alias("t"), agg.mean("x", 2).alias("m")).first()
    assert empty.t is None and empty.m is None
