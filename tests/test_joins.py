from pyspark.sql import functions as F

from martflow.operators import joins
from tests.helpers import rows


def test_repeat_by_matches_equals_the_join(spark):
    base = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    other = spark.createDataFrame([(1,)] * 7 + [(3,), (None,)], "k int")
    expected = rows(base.join(other, "k", "left").select("k", "v"))
    assert rows(joins.repeat_by_matches(base, other, ["k"])) == expected
    assert rows(joins.repeat_by_matches(base, other, ["k"], chunk=3)) == expected
    assert rows(joins.repeat_by_matches(base, other, ["k"], chunk=7)) == expected


def test_repeat_by_matches_spreads_a_hot_key(spark):
    base = spark.createDataFrame([(1,)], "k long")
    other = spark.range(50_000).select(F.lit(1).cast("bigint").alias("k"))
    spread = joins.repeat_by_matches(base, other, ["k"], chunk=1_000)
    per_task = spread.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 50_000 and len(per_task) > 1


def test_summary_equals_the_constant_join(spark):
    base = spark.createDataFrame([(1, 2.0), (2, 4.0), (2, 6.0)], "k int, x double")
    lookup = spark.createDataFrame([(10, None), (20, 3)], "t int, p int")
    measures = {"avg_t": F.avg("t"), "max_p": F.max("p")}
    joined = base.join(lookup, F.lit(True), "left").groupBy("k").agg(
        F.avg("x").alias("x"), F.avg("t").alias("avg_t"), F.max("p").alias("max_p")
    )
    attached = joins.attach_summary(base.groupBy("k").agg(F.avg("x").alias("x")), lookup, measures)
    assert rows(attached) == rows(joined)
    empty = joins.attach_summary(base, lookup.where("t < 0"), measures)
    assert all(r.avg_t is None and r.max_p is None for r in empty.collect()) and empty.count() == 3


def test_self_join_with_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (2, "c", 7), (None, "d", 8)], "k int, x string, y int")
    expected = df.alias("l").join(df.alias("r"), F.col("l.k") == F.col("r.k"), "left").select("l.k", "l.x", "r.y")
    found = joins.joined_to_itself(df, ["k"], ["x"], ["y"])
    assert rows(found) == rows(expected) and found.count() == 6


def test_cast_key_join(spark):
    base = spark.createDataFrame([("1",), ("CROP_1",), (None,), ("2",)], "crop_id string")
    crops = spark.createDataFrame([(1, "corn")], "crop_id int, crop_name string")
    joined = joins.join_cast_key(base, crops.withColumnRenamed("crop_id", "key"), "crop_id", "key")
    assert rows(joined) == [("1", "corn"), ("2", None), ("CROP_1", None), (None, None)]


def test_combined_dimensions_keep_keys_of_either(spark):
    a = spark.createDataFrame([(1, "a")], "k int, x string")
    b = spark.createDataFrame([(2, "b")], "k int, y string")
    assert rows(joins.combined([a, b], ["k"])) == [(1, "a", None), (2, None, "b")]


def test_one_per_key(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (2, None, 3)], "k int, v string, w int")
    assert rows(joins.one_per_key(df, ["k"])) == [(1, "a", 9), (2, None, 3)]


def test_first_rows(spark):
    df = spark.range(50).repartition(5)
    assert [r.id for r in joins.first_rows(df, ["id"], 3).collect()] == [0, 1, 2]


def test_small_dimension_goes_whole(spark):
    base = spark.range(1000).withColumnRenamed("id", "key")
    names = spark.range(10).select(F.col("id").alias("key"), F.lit("name").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [base.join(joins.sent_whole(names, most), "key", "left") for most in (10_000, 100)]
        assert [_told(p).count("BroadcastHashJoin") for p in plans] == [1, 0]
        assert rows(plans[0]) == rows(plans[1])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_not_dealt(spark):
    even = spark.range(300_000).select((F.col("id") % 5000).alias("key"), "id")
    hot = even.withColumn("key", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("key")))
    none = even.withColumn("key", F.when(F.col("id") % 3 > 0, F.col("key")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        dealt = [joins.dealt_once(df, "key") for df in (even, hot, none.union(none), even.limit(0))]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [_told(df).count("REPARTITION_BY_COL") for df in dealt] == [1, 0, 0, 0]


def _told(df):
    return df._jdf.queryExecution().executedPlan().toString()
