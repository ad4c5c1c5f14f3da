from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.operators.ranking import Rank, add_ranks, change_from_previous, ranged_rank, salted, window_rank
from tests.helpers import rows

entries = st.lists(
    st.tuples(
        st.sampled_from(["x", "y", None]),
        st.one_of(st.none(), st.sampled_from([1.0, 2.0, 2.5])),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(entries)
def test_distributed_rank_equals_window(spark, values):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(values)], "id int, g string, v double")
    ranks = [Rank("overall", "v", ["id"]), Rank("inside", "v", ["id"], within=["g"])]
    expected = df
    for rank in ranks:
        expected = window_rank(expected, rank)
    assert rows(add_ranks(df, ranks)) == rows(expected)


def test_hot_group_with_equal_values_is_spread(spark):
    df = spark.range(20_000).select(
        "id", F.lit("hot").alias("g"), F.when(F.col("id") < 15_000, 1.0).otherwise(F.col("id") * 1.0).alias("v")
    )
    rank = Rank("r", "v", [], within=["g"])
    ranked = ranged_rank(salted(df), rank)
    assert sorted(r.r for r in ranked.select("r").collect()) == list(range(1, 20_001))
    ordered = ranked.orderBy("r").collect()
    assert all(a.v >= b.v for a, b in zip(ordered, ordered[1:]))


def test_nulls_rank_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 7.0)], "id int, v double")
    for rank in (window_rank, ranged_rank):
        assert rows(rank(salted(df), Rank("r", "v", ["id"])).select("id", "r")) == [(1, 3), (2, 2), (3, 1)]


def test_change_from_previous_available_or_calendar_year(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 3.0), ("a", 2023, 4.0)], "k string, y int, v double")
    assert rows(change_from_previous(df, "v", ["k"], "y", "c"), "y", "c") == [(2020, None), (2021, 2.0), (2023, 1.0)]
    strict = change_from_previous(df, "v", ["k"], "y", "c", calendar=True)
    assert rows(strict, "y", "c") == [(2020, None), (2021, 2.0), (2023, None)]
