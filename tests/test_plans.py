"""Shapes of physical plans that matter at scale."""

import pytest

from martflow.bindings.testdata import Binding
from martflow.plans import marts
from martflow.workload import lake, relational, scalars, supply, tables  # noqa: F401
from martflow.workload.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
MARTS = ["seasonal_performance", "sustainability_metrics"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def all_lazy():
    writing = {
        "scan_drifting", "scan_drifting_partitioned", "write_star", "partitioned_roundtrip", "partition_overwrite", "append_evolve",
        "create_if_absent", "replace_table", "seed_csv_roundtrip", "messy_csv",
        "catalog_contract", "table_of_file", "seed_reload", "write_star_fact", "marts_run",
    }
    return [n for n in QUERIES if n not in writing and not n.startswith("stream_")]


@pytest.mark.parametrize("name", all_lazy())
def test_no_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "MapInPandas"):
        assert operator not in text, operator


def test_scan_reads_only_the_needed_columns(spark):
    rollup = QUERIES["agg_count_distinct"](spark, SMALL)
    text = rollup._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_returnflag:string>" in text


def test_filter_reaches_the_scan(spark):
    binding = Binding(spark, SMALL)
    text = plan(binding.soil)
    assert "PushedFilters: [IsNotNull(s_acctbal), GreaterThanOrEqual(s_acctbal,0.0)]" in text


def test_constant_lookup_is_a_subquery(spark):
    text = plan(QUERIES["join_constant_lookup"](spark, SMALL))
    assert "Subquery" in text and "Join" not in text.replace("BroadcastHashJoin LeftOuter", "").split("Subquery")[0]


@pytest.mark.parametrize("name", MARTS)
def test_marts_have_no_single_partition_step(spark, name):
    """Only the keyless lookup, a scalar subquery, is gathered in one place."""
    text = plan(QUERIES[name](spark, SMALL))
    main = text.split("Subquery", 1)[0]
    assert "SinglePartition" not in main


@pytest.mark.parametrize("name", ["farm_performance", "crop_performance"])
def test_ranked_marts_before_they_are_stored(spark, name, monkeypatch):
    """With nothing broadcast, the joins below the ranks keep their keys and gather nothing in one place."""
    monkeypatch.setattr(marts, "add_ranks", lambda metrics, ranks: metrics)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in text and "hashpartitioning" in text
    for operator in ("SinglePartition", "CartesianProduct", "NestedLoop", "Window"):
        assert operator not in text, operator


def test_unbroadcast_dimension_joins_once(spark):
    """With nothing small enough to broadcast, farms, usage and soil join the records in one step."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["sustainability_metrics"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("FullOuter") == 2 and text.count("LeftOuter") == 3


def test_hot_keys_are_split(spark):
    """A farm with a third of all records: its join is split, also where an aggregate on the farm follows."""
    from pyspark.sql import functions as F

    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    payload = F.sha2(F.col("id").cast("string"), 256).alias("payload")
    records = spark.range(100_000).select(hot.alias("farm_id"), (F.col("id") % 7).alias("x"), payload)
    farms = spark.range(1000).select(F.col("id").alias("farm_id"), F.lit("n").alias("farm_name"))
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for key, value in lowered.items():
        spark.conf.set(key, value)
    try:
        joined = records.repartition(8).join(farms, "farm_id", "left")
        counted = joined.groupBy("farm_id", "x").agg(F.count(F.lit(1)).alias("n"), F.max("payload"))
        found = counted.agg(F.sum("n")).first()[0]
        counted.collect()
        text = plan(counted)
    finally:
        for key in lowered:
            spark.conf.unset(key)
    assert found == 100_000 and "SortMergeJoin(skew=true)" in text
