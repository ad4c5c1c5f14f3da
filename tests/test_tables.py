from datetime import date

from pyspark.sql import functions as F

from martflow.sinks import tables
from martflow.workload.registry import table_name
from tests.helpers import rows


def test_append_lets_the_schema_grow(spark, path):
    table = table_name("grow")
    first = spark.createDataFrame([(1, date(2024, 1, 5)), (2, date(2024, 2, 6))], "id long, day date")
    second = spark.createDataFrame([(3, "x", date(2024, 2, 7))], "id long, extra string, day date")
    third = spark.createDataFrame([(date(2024, 3, 1),)], "day date")
    for part in (first, second, third):
        tables.append_evolving(part, table, "day", ["id"], path("t"))
    found = spark.table(table)
    assert rows(found, "id", "extra", "planting_month") == [
        (1, None, "2024-01"), (2, None, "2024-02"), (3, "x", "2024-02"), (None, None, "2024-03"),
    ]
    pruned = found.where("planting_month = '2024-02'")
    assert "PartitionFilters: [isnotnull(planting_month" in pruned._jdf.queryExecution().toString()
    spark.sql(f"DROP TABLE {table}")


def test_existing_table_is_not_even_planned(spark, path):
    table = table_name("once")
    assert tables.create_if_absent(spark, table, lambda: spark.range(3), path("once"))

    def must_not_run():
        raise AssertionError("planned")

    assert not tables.create_if_absent(spark, table, must_not_run)
    other = table_name("other")
    created = tables.create_all_if_absent(spark, {table: must_not_run, other: lambda: spark.range(1)})
    assert created == [other]
    for name in (table, other):
        spark.sql(f"DROP TABLE {name}")


def test_replace_and_temporary_view(spark, path):
    table = table_name("swap")
    tables.replace_table(spark.range(3), table, path("swap"))
    with tables.temporary_view(spark.range(5), "passing") as view:
        tables.replace_table(spark.table(view).select(F.col("id").alias("x")), table, path("swap2"))
    assert spark.table(table).columns == ["x"] and spark.table(table).count() == 5
    assert not spark.catalog.tableExists("passing")
    spark.sql(f"DROP TABLE {table}")


def test_seed_reload_replaces_everything(spark, tmp_path):
    table, file = table_name("seed"), tmp_path / "seed.csv"
    for text, expected in (("id,v\n1,a\n2,b\n", [(1, "a"), (2, "b")]), ("id,v\n2,c\n", [(2, "c")])):
        file.write_text(text)
        stored = tables.reload_seed(spark, str(file), "id int, v string", table, str(tmp_path / "stored"))
        assert rows(stored) == expected
    spark.sql(f"DROP TABLE {table}")
