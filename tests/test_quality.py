import pytest

from martflow.operators import quality
from martflow.operators.quality import Accepted, InRange, NotNull, Unique
from tests.helpers import rows


def test_checks_count_violations(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", 11), (None, "c", None), (None, None, 0)], "id long, kind string, scale int"
    )
    results = quality.run_checks(
        df, [NotNull("id", "error"), Accepted("kind", ["a", "b"]), InRange("scale", 1, 10), Unique("id")]
    )
    assert rows(results) == [
        ("accepted", "kind", "warn", 1), ("in_range", "scale", "warn", 2), ("not_null", "id", "error", 2),
        ("unique", "id", "warn", 1),
    ]
    with pytest.raises(quality.CheckFailed, match="not_null"):
        quality.enforce(results)
    warnings = quality.enforce(results.where("severity = 'warn'"))
    assert sorted(warnings) == ["accepted(kind): 1", "in_range(scale): 2", "unique(id): 1"]


def test_row_checks_share_one_scan(spark):
    df = spark.range(10)
    results = quality.run_checks(df, [NotNull("id"), InRange("id", 0, 3), Accepted("id", [1])])
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def test_duplicated_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "a int, b int")
    assert rows(quality.duplicated_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_contract_and_reconciliation(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    report = quality.contract_report(df, ["a", "c"])
    assert rows(report, "column_name", "status") == [("a", "ok"), ("b", "unexpected"), ("c", "missing")]
    assert rows(quality.reconcile(spark.range(5), spark.range(3))) == [(5, 3, 2)]


def test_profile_and_preview(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(quality.profile(df)) == [("a", "int", 2, 0), ("b", "string", 2, 1)]
    assert quality.preview(df, 1).count() == 1


def test_dictionary_and_key_checks(spark):
    from martflow.bindings import agri
    from martflow.plans import staging

    records = spark.createDataFrame(
        [("Mixed", 3, "Organic"), ("Zoo", 11, None)], "Farm_Type string, Soil_Fertility int, Certification string"
    )
    results = quality.run_checks(records, agri.dictionary_checks(records.columns))
    assert rows(results, "column_name", "violations") == [
        ("Certification", 0), ("Farm_Type", 1), ("Soil_Fertility", 1),
    ]
    soil = spark.createDataFrame([(1,), (1,), (None,)], "soil_id long")
    results = quality.run_checks(soil, staging.key_checks("stg_soil"))
    assert rows(results, "check_name", "violations") == [("not_null", 1), ("unique", 1)]


def test_unique_checks_share_one_shuffle(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.0, None, 1, 1), (1, "b", -0.0, None, 2, 1), (2, None, 1.0, "x", 3, 2), (None, None, None, "x", 4, 2), (2, "c", None, "x", 5, None)],
        "a long, b string, c double, d string, e int, f int",
    )
    results = quality.run_checks(df, [Unique(c) for c in "abcdef"])
    assert [(r["column_name"], r["violations"]) for r in results.collect()] == [
        ("a", 2), ("b", 0), ("c", 1), ("d", 1), ("e", 0), ("f", 2),
    ]
    plan = results._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_checks_are_counted_while_writing(spark, path):
    df = spark.createDataFrame([(1, "a", 5), (None, "c", 11)], "id long, kind string, scale int")
    checks = [NotNull("id", "error"), Accepted("kind", ["a", "b"]), InRange("scale", 1, 10)]
    watched, told = quality.observe_checks(df, checks)
    watched.write.parquet(path("t"))
    assert sorted(told()) == rows(quality.run_checks(df, checks)) and quality.observe_checks(df, [])[1]() == []


def reconciled(source, target, **given):
    found = quality.differing_keys(source, target, ["k"], **given)
    return {r["k"]: (r["n_source"], r["n_target"], r["kind"]) for r in found.collect()}


def test_reconciliation_by_content(spark):
    source = spark.range(3000).selectExpr("id as k", "id % 7 as slice", "if(id % 5 = 0, null, id * 2) as x", "cast(null as string) as y")
    changed = "case k when 10 then 1 when 11 then null else x end as x"
    target = source.where("k <> 12").selectExpr("y", "k", changed, "slice")
    target = target.unionByName(target.where("k in (13, 14)")).unionByName(source.where("k = 14").selectExpr("-k as k", "slice", "x", "y"))
    expected = {10: (1, 1, "changed"), 11: (1, 1, "changed"), 12: (1, 0, "missing"), 13: (1, 2, "count"), 14: (1, 2, "count"), -14: (0, 1, "extra")}
    assert reconciled(source, target) == expected == reconciled(source, target, slice_by="slice")
    assert reconciled(source, source.repartition(5)) == {}
    assert reconciled(source.limit(0), source.limit(0)) == {} and reconciled(source.limit(0), source.limit(2)) != {}


def test_nulls_in_keys_slices_and_other_columns_are_told_apart(spark):
    source = spark.createDataFrame([(None, None, "a", None), (1, 2, None, "a")], "k long, slice long, x string, y string")
    target = spark.createDataFrame([(None, None, None, "a"), (1, 2, None, "a")], "k long, slice long, x string, y string")
    assert reconciled(source, target, slice_by="slice") == {None: (1, 1, "changed")}


def test_equal_slices_are_pruned(spark, path):
    spark.range(1000).selectExpr("id as k", "id % 10 as slice", "id as x").write.partitionBy("slice").parquet(path("source"))
    spark.range(1000).selectExpr("id as k", "id % 10 as slice", "if(id = 23, 0, id) as x").write.partitionBy("slice").parquet(path("target"))
    found = quality.differing_keys(spark.read.parquet(path("source")), spark.read.parquet(path("target")), ["k"], slice_by="slice")
    assert [tuple(r) for r in found.collect()] == [(23, 1, 1, "changed")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(slice" in plan or "PartitionFilters: [isnotnull(slice" in plan
