from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.bindings import agri
from martflow.functions.scalar import table_of_path
from martflow.operators.conform import align
from martflow.sinks import files as sinks
from martflow.sources import catalog
from martflow.sources import files as sources
from tests.helpers import rows


def drifting_files(folder):
    folder.mkdir()
    tables = {
        "a": {"id": [1, 2], "Pesticide_Amount": pa.array([0, 3], pa.int64()), "note": ["x", "y"]},
        "b": {"id": [3], "Pesticide_Amount": pa.array([5.34], pa.float64()), "note": ["z"]},
        "c": {"id": [4], "note": ["w"]},
        "d": {"note": ["v"], "id": [5], "Pesticide_Amount": pa.array([7], pa.int64())},
    }
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    (folder / "_marker").write_text("not parquet")


def test_drifting_files_are_read_once_per_schema(spark, tmp_path):
    drifting_files(tmp_path / "raw files")
    path = str(tmp_path / "raw files")
    groups = sources.schema_groups(spark, path)
    assert sorted(len(group.paths) for group in groups.values()) == [1, 1, 2]
    df = sources.read_drifting(spark, path, ["Pesticide_Amount", "Irrigation_Amount"])
    assert rows(df, "id", "Pesticide_Amount", "note") == [
        (1, 0.0, "x"), (2, 3.0, "y"), (3, 5.34, "z"), (4, 0.0, "w"), (5, 7.0, "v"),
    ]
    declared = T.StructType.fromDDL("id long, Pesticide_Amount double, Irrigation_Amount double")
    typed = sources.read_drifting(spark, path, schema=declared, fill=None)
    assert typed.schema == declared and typed.where("Irrigation_Amount is null").count() == 5
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", True).parquet(f"{path}/*.parquet").collect()


def test_drifting_scan_equals_the_union_of_casts(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(12):
        kind = [pa.int64(), pa.float64(), pa.int32()][i % 3]
        values = {"k": [i, i], "amount": pa.array([i, None], kind)}
        pq.write_table(pa.table(values), folder / f"{i}.parquet")
    frames = [
        spark.read.parquet(str(folder / f"{i}.parquet")).withColumn("amount", F.col("amount").cast("double"))
        for i in range(12)
    ]
    naive = frames[0]
    for frame in frames[1:]:
        naive = naive.unionByName(frame)
    found = sources.read_drifting(spark, str(folder), ["amount"])
    assert rows(found, "k", "amount") == rows(naive.na.fill(0, ["amount"]), "k", "amount")


def test_seed_csv(spark, tmp_path):
    file = tmp_path / "seed.csv"
    file.write_text("farm_id,farm_name,farm_location,farm_size,established_date\n1,Hill,North,40,2001-02-03\n")
    schema = agri.seed_schema("seed_farm")
    assert rows(sources.read_seed(spark, str(file), schema)) == [(1, "Hill", "North", 40, date(2001, 2, 3))]
    file.write_text("farm_id,farm_name,farm_location,farm_size,established_date\n1,Hill,North,many,2001-02-03\n")
    with pytest.raises(Exception):
        sources.read_seed(spark, str(file), schema).collect()
    file.write_text("id,farm_name,farm_location,farm_size,established_date\n1,Hill,North,4,2001-02-03\n")
    with pytest.raises(Exception):
        sources.read_seed(spark, str(file), schema).collect()


def test_messy_csv(spark, tmp_path):
    file = tmp_path / "messy.csv"
    file.write_bytes(b'id,name\r\n1,"say ""hi"", twice"\r\n\r\n   \r\n2,plain\n\n3,last')
    schema = T.StructType.fromDDL("id int, name string")
    assert rows(sources.read_messy_csv(spark, str(file), schema)) == [
        (1, 'say "hi", twice'), (2, "plain"), (3, "last"),
    ]


def test_dictionary(spark, tmp_path):
    file = tmp_path / "dictionary.csv"
    file.write_text('FIELDS,DESCRIPTION\nColour,":  Kind of colour: Red, Dark Blue"\n Size ,:  Size in metres\n')
    dictionary = sources.read_dictionary(spark, str(file))
    assert rows(dictionary) == [("Colour", "Kind of colour: Red, Dark Blue"), ("Size", "Size in metres")]
    assert rows(sources.dictionary_values(dictionary)) == [("Colour", "Dark Blue"), ("Colour", "Red")]


def test_default_only_for_a_missing_path(spark, path):
    default = spark.createDataFrame([(1,)], "a int")
    found = sources.read_or_default(lambda: spark.read.parquet(path("nothing")), lambda: default)
    assert rows(found) == [(1,)]
    with pytest.raises(AnalysisException):
        sources.read_or_default(lambda: default.select("missing_column"), lambda: default)


def test_rows_with_a_schema(spark):
    df = sources.read_rows(spark, [("F", None)], "Farm_ID string not null, size double")
    assert not df.schema["Farm_ID"].nullable and rows(df) == [("F", None)]


def test_data_present(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "full"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    (tmp_path / "markers").mkdir()
    (tmp_path / "markers" / "_SUCCESS").write_text("")
    paths = {name: str(tmp_path / name) for name in ("full", "empty", "markers", "absent")}
    assert sources.data_present(spark, paths) == {"full": True, "empty": False, "markers": False, "absent": False}


def test_partitioned_write_and_pruned_read(spark, path):
    df = spark.range(100).select("id", (F.col("id") % 3 + 2000).cast("int").alias("year"), F.lit(5).alias("month"))
    sinks.write_partitioned(df, path("t"), ["year", "month"], ["id"])
    assert rows(sources.read_partitioned(spark, path("t"))) == rows(df)
    one = sources.read_partitioned(spark, path("t"), ["year=2001"])
    assert rows(one) == rows(df.where("year = 2001"))
    table = one.select(table_of_path(F.col("_metadata.file_path")).alias("t")).distinct()
    assert rows(table) == [("t",)]
    sinks.write_partitioned(df.where("year = 2001 and id < 10"), path("t"), ["year", "month"])
    kept = sources.read_partitioned(spark, path("t")).groupBy("year").count()
    assert rows(kept) == [(2000, 34), (2001, 3), (2002, 33)]


def test_tables_are_all_tried(spark, path):
    good = spark.range(3)
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(sinks.WriteFailed, match="bad"):
        sinks.write_tables({"bad": bad, "good": good}, path("out"))
    assert spark.read.parquet(path("out") + "/good").count() == 3


def test_messages_round_trip(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, v string")
    messages = sinks.as_messages(df, "id")
    sinks.publish(messages, path("landing"))
    parsed = spark.read.schema("id long, v string").json(path("landing"))
    assert rows(parsed) == rows(df) and rows(messages.select("key")) == [("1",), ("2",)]


def test_catalog_source_checks_its_contract(spark):
    catalog.as_views({"contracted": spark.createDataFrame([(1, 2)], "a int, b int")})
    assert catalog.source(spark, "contracted", ["a", "b"]).count() == 1
    with pytest.raises(catalog.ContractBroken, match="c"):
        catalog.source(spark, "contracted", ["a", "c"])
    view = catalog.view_of(spark, "lazy_view", lambda: spark.range(4))
    assert view.count() == 4


def test_drifting_scan_keeps_partitions_and_turns_bad_texts_to_null(spark, path):
    first = spark.createDataFrame([(1, 2020, 5), (2, 2021, 6)], "id int, year int, amount long")
    second = spark.createDataFrame([(3, 2021, "n/a"), (4, 2022, "7.5")], "id int, year int, amount string")
    first.write.partitionBy("year").parquet(path("lake"))
    second.write.mode("append").partitionBy("year").parquet(path("lake"))
    found = sources.read_drifting(spark, path("lake"), ["amount"], fill=None)
    assert rows(found, "id", "year", "amount") == [(1, 2020, 5.0), (2, 2021, 6.0), (3, 2021, None), (4, 2022, 7.5)]


def test_drifting_scan_of_nothing_says_so(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.read_drifting(spark, str(tmp_path))


def test_align_refuses_to_cut_numbers(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    whole = T.StructType.fromDDL("x bigint")
    assert rows(align(df, whole)) == [(1,), (None,)]
    with pytest.raises(Exception, match="integer column"):
        align(spark.createDataFrame([(1.75,)], "x double"), whole).collect()


def test_messy_csv_fails_on_a_bad_value(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,v\n1,2\n2,x\n")
    with pytest.raises(Exception):
        sources.read_messy_csv(spark, str(tmp_path / "bad.csv"), T.StructType.fromDDL("id int, v bigint")).collect()


def test_align_refuses_to_round_or_cut(spark):
    given = spark.sql("select cast(1.25 as decimal(5,2)) d, timestamp'2024-01-02 03:00:00' t, cast(0.1 as double) x, 9007199254740993 n")
    for column, kind in (("d", "decimal(4,1)"), ("t", "date"), ("x", "float"), ("n", "double")):
        with pytest.raises(Exception, match="can't hold"):
            align(given, T.StructType.fromDDL(f"{column} {kind}")).collect()
    fits = spark.sql("select cast(1.20 as decimal(5,2)) d, timestamp'2024-01-02' t, cast(0.5 as double) x, 4 n")
    aligned = align(fits, T.StructType.fromDDL("d decimal(4,1), t date, x float, n double"))
    assert [str(v) for v in aligned.first()] == ["1.2", "2024-01-02", "0.5", "4.0"]


def test_values_that_do_not_fit_are_kept(spark, path):
    spark.createDataFrame([(1, 5)], "id int, amount long").write.parquet(path("lake/a"))
    texts = [(2, "n/a"), (3, "7.5"), (4, None), (5, "")]
    spark.createDataFrame(texts, "id int, amount string").write.parquet(path("lake/b"))
    spark.createDataFrame([(6, 2**53 + 1)], "id int, amount long").write.parquet(path("lake/c"))
    spark.createDataFrame([(7,)], "id int").write.parquet(path("lake/d"))
    found = sources.read_drifting(spark, path("lake"), ["amount"], rescued="_rescued")
    assert sorted(tuple(r) for r in found.select("id", "amount", "_rescued").collect()) == [
        (1, 5.0, None), (2, None, {"amount": "n/a"}), (3, 7.5, None), (4, 0.0, None), (5, None, {"amount": ""}),
        (6, None, {"amount": str(2**53 + 1)}), (7, 0.0, None),
    ]


class Footers:
    """Counts the footers that scans have added to an index."""

    def __init__(self, spark, index):
        self.spark, self.index, self.before = spark, index, 0

    def opened(self):
        now = self.spark.read.schema(sources.FOOTER).parquet(self.index).count()
        opened, self.before = now - self.before, now
        return opened


def test_only_new_and_changed_files_are_opened(spark, tmp_path):
    folder = tmp_path / "lake"
    for part, kind in (("a", pa.int64()), ("b", pa.float64())):
        (folder / part).mkdir(parents=True)
        for i in range(4):
            pq.write_table(pa.table({"id": [i], "amount": pa.array([i], kind)}), folder / part / f"{i}.parquet")
    index = str(tmp_path / "index")
    footers = Footers(spark, index)

    def scan():
        return rows(sources.read_drifting(spark, str(folder), ["amount"], index=index), "id", "amount")

    assert len(scan()) == 8 and footers.opened() == 8
    assert len(scan()) == 8 and footers.opened() == 0
    pq.write_table(pa.table({"id": [9], "amount": pa.array([2.5])}), folder / "a" / "new.parquet")
    pq.write_table(pa.table({"id": [7, 7], "amount": pa.array([1, 1], pa.int64())}), folder / "b" / "0.parquet")
    found = scan()
    assert footers.opened() == 2 and (9, 2.5) in found and found.count((7, 1.0)) == 2 and len(found) == 10
    (folder / "a" / "new.parquet").unlink()
    assert len(scan()) == 9 and footers.opened() == 0


def test_directories_of_one_schema_are_handed_over_whole(spark, path):
    spark.range(40).selectExpr("id", "id % 5 as part", "id * 1.5d as amount").write.partitionBy("part").parquet(path("lake"))
    spark.range(8).selectExpr("id", "0L as part", "id as amount").write.mode("append").partitionBy("part").parquet(path("lake"))
    groups = sources.schema_groups(spark, path("lake"))
    places = [place for group in groups.values() for place in group.paths]
    assert sum(place.endswith(".parquet") for place in places) >= 2  # those of part=0
    assert {place.rsplit("/", 1)[1] for place in places if not place.endswith(".parquet")} == {f"part={k}" for k in range(1, 5)}
    assert all(group.schema is not None for group in groups.values())
    assert sources.read_drifting(spark, path("lake"), ["amount"]).groupBy("part").count().count() == 5


def test_directories_above_others_are_not_handed_over(spark, tmp_path):
    folder = tmp_path / "deep"
    (folder / "below").mkdir(parents=True)
    pq.write_table(pa.table({"id": [1], "amount": [1]}), folder / "a.parquet")
    pq.write_table(pa.table({"id": [2], "amount": [2.5]}), folder / "below" / "b.parquet")
    assert rows(sources.read_drifting(spark, str(folder), ["amount"]), "id", "amount") == [(1, 1.0), (2, 2.5)]
