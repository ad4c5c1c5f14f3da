"""Roll-ups refreshed from commits equal those over all records, bit for bit, and read new files alone."""

import pytest
from pyspark.sql import functions as F

from martflow.functions import aggregate as agg
from martflow.plans.olap import mean_rollup
from martflow.plans.refresh import Measure, Rollup, Shown, compact_state, refresh
from martflow.sinks.committed import CommittedTable
from tests.helpers import rows



def measures(*names):
    return {name: Measure(F.col(name)) for name in names}


def records(spark, low, high, month):
    return spark.range(low, high).selectExpr(
        f"'{month}' as month", "if(id % 11 = 0, null, concat('k', id % 3)) as kind", "pmod(xxhash64(id), 100) / 7 as x",
        "if(id % 4 = 0, null, cast(id as int)) as y", "pmod(xxhash64(id, 1), 70000) - 100 as farm",
    )


@pytest.fixture
def rollup(spark):
    return Rollup(["kind"], measures("x", "y"), distinct="farm")


@pytest.fixture
def tables(spark, path, rollup):
    source = CommittedTable(spark, path("source"), "month", ["farm"])
    return source, rollup.state_table(spark, path("state"), "month")


def full(source):
    everything = source.read()
    means = mean_rollup(everything, ["kind"], ["x", "y"], exact=4)
    ids = {r["kind"]: r["n"] for r in everything.selectExpr("kind", "farm").distinct().groupBy("kind").count().withColumnRenamed("count", "n").collect()}
    return sorted(((r["kind"], r["avg_x"], r["avg_y"], ids[r["kind"]]) for r in means.collect()), key=str)


def shown(state, rollup):
    return sorted((tuple(r) for r in rollup.result(state.read()).select("kind", "avg_x", "avg_y", "n_farm").collect()), key=str)


def test_refreshed_equals_full(spark, tables, rollup):
    source, state = tables
    assert refresh(source, state, rollup) is None
    for k, month in enumerate(("2024-01", "2024-02", "2024-01")):
        source.append(records(spark, 3000 * k, 3000 * k + 2000, month))
        assert refresh(source, state, rollup) is not None and refresh(source, state, rollup) is None
        assert shown(state, rollup) == full(source)
    source.compact()
    refresh(source, state, rollup)
    assert shown(state, rollup) == full(source)
    before = shown(state, rollup)
    assert compact_state(state, rollup) is not None and shown(state, rollup) == before
    keys = state.read().select("month", "kind", "_id_bucket")
    assert keys.count() == keys.distinct().count()


def test_only_new_files_are_read(spark, tables, rollup, monkeypatch):
    source, state = tables
    source.append(records(spark, 0, 2000, "2024-01"))
    refresh(source, state, rollup)
    read, since = [], CommittedTable.since

    def counted(self, *given):
        found = since(self, *given)
        read.extend(found.inputFiles())
        return found

    monkeypatch.setattr(CommittedTable, "since", counted)
    source.append(records(spark, 5000, 5100, "2024-02"))
    refresh(source, state, rollup)
    assert read and all("2024-02" in file for file in read)


def test_a_refresh_that_is_lost_counts_once(spark, tables, rollup, monkeypatch):
    source, state = tables
    source.append(records(spark, 0, 500, "2024-01"))
    publish = CommittedTable._publish
    monkeypatch.setattr(CommittedTable, "_publish", lambda self, change: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh(source, state, rollup)
    monkeypatch.setattr(CommittedTable, "_publish", publish)
    refresh(source, state, rollup)
    assert shown(state, rollup) == full(source)


def test_conditions_totals_and_fine_decimals(spark):
    df = records(spark, 0, 3000, "2024-01").unionByName(records(spark, 3000, 5000, "2024-02"))
    rollup = Rollup(["kind", "month"], {"x": Measure(F.col("x") / 3, 10), "y": Measure(F.col("y"))})
    state = rollup.state_of(df, "month")
    shown = {"fine": Shown("x"), "all": Shown("y", total=True), "late": Shown("x", F.col("month") == "2024-02"), "none": Shown("y", F.lit(False))}
    full = df.groupBy("kind").agg(
        agg.mean(F.col("x") / 3, 10).alias("fine"), agg.total("y", 4).alias("all"),
        agg.mean_where(F.col("month") == "2024-02", F.col("x") / 3, 10).alias("late"), F.lit(None).cast("double").alias("none"),
    )
    assert rows(rollup.result(state, ["kind"], shown)) == rows(full)


def test_ids_must_be_integers(spark):
    with pytest.raises(ValueError, match="kind"):
        Rollup(["month"], measures("x"), distinct="kind").state_of(records(spark, 0, 2, "m"), "month")
    means = Rollup(["kind"], measures("x")).state_of(records(spark, 0, 9, "m"), "month")
    assert rows(Rollup(["kind"], measures("x")).result(means), "kind") == rows(records(spark, 0, 9, "m").select("kind").distinct())


def test_records_of_a_refreshed_mart_are_built_once(spark):
    from martflow.bindings.testdata import Binding
    from martflow.plans import refresh as plan
    from martflow.workload.tables import RECORDS, refreshed

    b = Binding(spark, "/root/testdata/sf0.001")
    given = b.records.limit(500).localCheckpoint()
    built = spark.sparkContext.accumulator(0)

    def tell(year):
        built.add(1)
        return year

    b.records = given.withColumn("year", F.udf(tell, "int").asNondeterministic()("year"))
    state = refreshed(b, plan.farm_rollup(RECORDS), "once")
    assert state.agg(F.sum("n_actual_yield")).first()[0] == 500
    assert built.value == 500
