"""Tables with a commit log: visibility, widening, pruning, compaction, conflicts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.widen import SchemaConflict, merged, wider
from martflow.sinks.committed import CommitConflict, CommittedTable
from tests.helpers import rows


@pytest.fixture
def table(spark, path):
    return CommittedTable(spark, path("a table"), "month", ["farm"])


def records(spark, *given):
    return spark.createDataFrame(given, "month string, farm long, amount int")


def test_nothing_yet(table):
    assert table.versions() == [] and table.files().count() == 0
    assert table.version().number == 0 and table.compact() is None and table.vacuum() == []


def test_versions_are_seen_whole(spark, table):
    assert table.append(records(spark, ("2024-01", 1, 1), (None, 2, 2))) == 1
    assert table.append(records(spark, ("2024:02 %/x", 3, None))) == 2
    assert rows(table.read(version=1)) == rows(records(spark, ("2024-01", 1, 1), (None, 2, 2)))
    assert table.read().count() == 3 and table.since(1, 2).count() == 1 and table.since(0, 2).count() == 3
    assert rows(table.read(slices=["2024:02 %/x"])) == [("2024:02 %/x", 3, None)]
    assert table.append(records(spark).limit(0)) == 3 and table.read().count() == 3


def test_a_batch_is_committed_once(spark, table):
    batch = records(spark, ("2024-01", 1, 1))
    assert table.append(batch, "w", 0) == 1 and table.append(batch, "w", 0) is None
    assert table.append(batch, "other", 0) == 2 and table.append(batch, "w", 1) == 3
    assert table.read().count() == 3


def test_two_writers_at_once(spark, table):
    first = table.prepare(records(spark, ("2024-01", 1, 1)), "a", 0)
    second = table.prepare(records(spark, ("2024-01", 2, 2)), "b", 0)
    again = table.prepare(records(spark, ("2024-01", 2, 2)), "b", 0)
    assert (second(), first(), again()) == (1, 2, None)
    assert rows(table.read(), "farm") == [(1,), (2,)]


def test_a_version_is_never_overwritten(spark, table, monkeypatch):
    table.append(records(spark, ("2024-01", 1, 1)))
    base = table.version()
    monkeypatch.setattr(CommittedTable, "version", lambda self, number=None: type(base)())
    with pytest.raises(CommitConflict):
        table._publish(lambda version: version, attempts=3)
    monkeypatch.undo()
    assert table.version() == base


def test_schema_widens(spark, table):
    table.append(records(spark, ("2024-01", 1, 2**30)))
    table.append(spark.createDataFrame([("2024-01", 2, 2**40, "x")], "month string, farm long, amount long, note string"))
    table.append(spark.createDataFrame([("2024-01", 3, 0.5)], "month string, farm long, amount double"))
    assert dict(table.read().dtypes)["amount"] == "double"
    assert rows(table.read(), "farm", "amount", "note") == [(1, float(2**30), None), (2, float(2**40), "x"), (3, 0.5, None)]
    assert table.compact() is not None
    assert rows(table.read(), "farm", "amount", "note") == [(1, float(2**30), None), (2, float(2**40), "x"), (3, 0.5, None)]
    with pytest.raises(SchemaConflict, match="farm"):
        table.append(spark.createDataFrame([("2024-01", "a")], "month string, farm string"))


def test_a_point_lookup_reads_few_files(spark, path):
    table = CommittedTable(spark, path("t"), "month", ["farm", "crop"])
    # Farm 7 has a third of all rows.
    df = spark.range(30_000).selectExpr(
        "concat('2024-0', 1 + id % 2) as month", "if(id % 3 = 0, 7, pmod(xxhash64(id), 500)) as farm", "id % 17 as crop", "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        table.append(df.repartition(6))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = table.files()
    assert files.where("slice = '2024-01'").count() >= 2
    for farm in (3, 250, 499):
        found = table.read(within={"month": ("2024-01", "2024-01"), "farm": (farm, farm)})
        assert rows(found) == rows(df.where(f"month = '2024-01' and farm = {farm}"))
        assert len(found.inputFiles()) <= 2
    hot = table.read(within={"farm": (7, 7)})
    assert hot.count() == df.where("farm = 7").count()
    assert files.where("low_farm <= 7 and high_farm >= 7").groupBy("slice").count().agg(F.max("count")).first()[0] >= 2


def test_compaction_keeps_rows_and_concurrent_appends(spark, table):
    for k in range(6):
        table.append(records(spark, ("2024-01", k, k), ("2024-02", k, k)), by_range=False)
    before = rows(table.read())
    late = table.prepare(records(spark, ("2024-01", 100, 0)), by_range=False)
    version = table.compact()
    assert version is not None and rows(table.read()) == before and table.files().count() == 2
    late()
    assert table.read().count() == len(before) + 1
    assert table.since(version, table.version().number).count() == 1
    assert table.compact() is not None and table.compact() is None
    assert table.read().count() == len(before) + 1


def test_compaction_gives_way_to_an_append_before_it_is_published(spark, table, monkeypatch):
    for k in range(3):
        table.append(records(spark, ("2024-01", k, k)), by_range=False)
    late = table.prepare(records(spark, ("2024-01", 9, 9)), by_range=False)
    describe = CommittedTable._describe

    def with_append(self, *given):
        describe(self, *given)
        monkeypatch.setattr(CommittedTable, "_describe", describe)
        late()

    monkeypatch.setattr(CommittedTable, "_describe", with_append)
    assert table.compact() == 5
    assert rows(table.read(), "farm") == [(0,), (1,), (2,), (9,)] and table.files().count() == 2


def test_a_crash_before_publishing_changes_nothing(spark, table, monkeypatch):
    for k in range(3):
        table.append(records(spark, ("2024-01", k, k)), by_range=False)
    before, files = rows(table.read()), rows(table.files(), "path")

    def lost(self, change):
        raise RuntimeError("lost")

    monkeypatch.setattr(CommittedTable, "_publish", lost)
    for step in (table.compact, lambda: table.append(records(spark, ("2024-01", 9, 9)))):
        with pytest.raises(RuntimeError):
            step()
    monkeypatch.undo()
    assert rows(table.read()) == before and rows(table.files(), "path") == files
    gone = table.vacuum()
    assert sum(name.startswith("data/") for name in gone) == 2 and rows(table.read()) == before


def test_vacuum_deletes_what_no_kept_version_names(spark, table):
    for k in range(3):
        table.append(records(spark, ("2024-01", k, k)), by_range=False)
    before = rows(table.read())
    table.compact()
    assert not [name for name in table.vacuum(keep=2) if name.startswith("data/")]
    assert rows(table.read(version=3)) == before
    assert len([name for name in table.vacuum() if name.startswith("data/")]) == 3
    assert table.versions() == [4] and rows(table.read()) == before


KINDS = [T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(12, 2), T.DecimalType(38, 0),
         T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType(), T.NullType()]


def test_lattice():
    for a in KINDS:
        assert wider(a, a) == a
        for b in KINDS:
            assert wider(a, b) == wider(b, a)
            assert wider(wider(a, b), b) == wider(a, b)
    assert wider(T.IntegerType(), T.DecimalType(4, 2)) == T.DecimalType(12, 2)
    assert wider(T.LongType(), T.DecimalType(38, 0)) == T.DecimalType(38, 0)
    assert wider(T.DecimalType(38, 10), T.LongType()) == T.DecimalType(38, 10)
    inner = wider(T.StructType.fromDDL("a int, b string"), T.StructType.fromDDL("a double, c date"))
    assert inner.simpleString() == "struct<a:double,b:string,c:date>"
    assert merged(T.StructType.fromDDL("a int not null"), T.StructType.fromDDL("b date")).simpleString() == "struct<a:int,b:date>"


def test_a_manifest_does_not_sort_the_rows(spark, table, path):
    """Bounds of texts would: the partition value needs none, and text keys are made distinct before."""
    given = records(spark, ("2024-01", 1, 1), ("2024-01", 5, 1), (None, 2, 2), ("2024-02", None, 3))
    table.append(given)
    told = table._told(table.version().added, given.schema)
    assert "SortAggregate" not in told._jdf.queryExecution().executedPlan().toString()
    bounds = table.files().groupBy("slice", "low_month", "high_month").agg(
        F.sum("rows").alias("n"), F.min("low_farm"), F.max("high_farm")
    )
    january, february, none = ["2024-01"] * 3, ["2024-02"] * 3, [None] * 3
    assert rows(bounds) == [(*january, 2, 1, 5), (*february, 1, None, None), (*none, 1, 2, 2)]
    named = CommittedTable(spark, path("named"), "month", ["name", "farm"])
    named.append(given.withColumn("name", F.concat(F.lit("n"), F.col("farm"))))
    found = named.files().agg(F.min("low_name"), F.max("high_name"), F.min("low_farm"), F.max("high_farm"), F.sum("rows"))
    assert rows(found) == [("n1", "n5", 1, 5, 4)]
    assert named.read(within={"name": ("n2", "n4")}).count() == 1
