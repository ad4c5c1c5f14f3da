from datetime import date, datetime

from pyspark.sql import types as T

from martflow.bindings import agri
from martflow.operators import conform
from martflow.plans.star import conformed
from tests.helpers import rows


def test_cast_and_fill_only_touch_present_columns(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id long, a int")
    cast = conform.fill_nulls(conform.cast_present(df, ["a", "b"]), ["a", "b"])
    assert cast.columns == ["id", "a"] and rows(cast) == [(1, 0.0), (2, 5.0)]


def test_align_casts_orders_and_drops(spark):
    df = spark.createDataFrame([("x", 1, 2)], "extra string, b int, a int")
    aligned = conform.align(df, T.StructType.fromDDL("a double, b long, c string"))
    assert aligned.dtypes == [("a", "double"), ("b", "bigint"), ("c", "string")]
    assert rows(aligned) == [(2.0, 1, None)]


def test_union_fills_missing_columns(spark):
    frames = [spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x", 2)], "b string, a int")]
    assert rows(conform.union_all(frames).select("a", "b")) == [(1, None), (2, "x")]


def test_date_parts_of_text_and_timestamp(spark):
    text = spark.createDataFrame([("2024-05-06T07:08:09",), ("bad",)], "timestamp string")
    assert rows(conform.add_date_parts(text).drop("timestamp")) == [
        (date(2024, 5, 6), 2024, 5, 6), (None, None, None, None),
    ]
    stamp = spark.createDataFrame([(datetime(2024, 5, 6, 7),)], "timestamp timestamp")
    assert conform.add_date_parts(stamp).first().year == 2024
    other = spark.createDataFrame([(1,)], "x int")
    assert conform.add_date_parts(other).columns == ["x"]


def test_latest_by_key_takes_whole_newest_row(spark):
    df = spark.createDataFrame(
        [("a", 1, "old", None), ("a", 3, "new", 7), ("a", 2, "mid", 9), ("b", 1, None, None)],
        "k string, at int, v string, w int",
    )
    assert rows(conform.latest_by_key(df, ["k"], "at")) == [("a", 3, "new", 7), ("b", 1, None, None)]


def test_parse_json_separates_misfits(spark):
    schema = T.StructType.fromDDL("id string, amount double")
    texts = [
        ('{"id":"1","amount":0}',), ('{"id":"2","amount":5.34,"more":1}',), ('{"test":"connection"}',),
        ("not json",), ('{"id":"3","amount":"much"}',),
    ]
    parsed = conform.parse_json(spark.createDataFrame(texts, "value string"), schema, keep="text")
    good, bad = conform.split_valid(parsed, ["id"])
    assert rows(good, "id", "amount") == [("1", 0.0), ("2", 5.34)]
    assert [r[0] for r in rows(bad, "text")] == sorted([t[0] for t in texts[2:]])


def test_infer_json_schema(spark):
    found = conform.infer_json_schema(spark, '{"a":1,"b":1.5,"c":true,"d":"x"}')
    assert {f.name: f.dataType.simpleString() for f in found} == {
        "a": "bigint", "b": "double", "c": "boolean", "d": "string",
    }


def test_streamed_names_reach_the_batch_contract(spark):
    streamed = agri.stream_schema()
    assert "Soil_Fertility_Rating" in streamed.names and len(streamed.names) == 70
    assert len(agri.record_schema().names) == 55
    row = {"Farm_ID": "F", "Crop_ID": "C", "Soil_Fertility_Rating": 4, "Planting_Date": "2024-01-02"}
    df = spark.createDataFrame([tuple(row.get(n) for n in streamed.names)], streamed)
    shaped = conformed(df)
    assert shaped.first().Soil_Fertility == 4 and shaped.first().Planting_Date == date(2024, 1, 2)
    assert set(agri.record_schema().names) <= set(shaped.columns)


def test_schema_of_all_texts(spark):
    texts = ['{"a":1,"b":"x","d":{"k":1}}', '{"a":1.5,"late":true,"d":{"m":"s"},"odd key":[1,2.5]}', "nope", "[1]", None, '{"b":2,"z":null}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    schema = conform.infer_json_schema_of_all(df)
    assert schema.simpleString() == "struct<a:double,b:string,d:struct<k:bigint,m:string>,late:boolean,odd key:array<double>,z:string>"
    parsed = conform.parse_json(df, schema).select("a", "b", "late")
    assert [tuple(r) for r in parsed.collect()][:2] == [(1.0, "x", None), (1.5, None, True)]
    assert conform.infer_json_schema_of_all(df.where("value = 'nope'")) == T.StructType()
