import json
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators.conform import parse_json
from martflow.sinks.committed import CommittedTable
from martflow.sources.messages import Landing, Topic, read_messages
from martflow.streaming import export, ingest
from tests.helpers import rows



@pytest.fixture(scope="module")
def form(spark):
    return ingest.MessageFormat(
        T.StructType.fromDDL("message_id string, timestamp timestamp, farm long, amount double")
    )


def message(i, day=1, amount=None):
    return json.dumps(
        {"message_id": f"m{i}", "timestamp": f"2024-01-{day:02d}T10:00:00Z", "farm": i, "amount": amount or 0}
    )


class Site:
    def __init__(self, tmp_path):
        self.folder = tmp_path / "landing"
        self.folder.mkdir()
        self.where = Landing(str(self.folder), max_files=1)
        self.lake = ingest.Lake(str(tmp_path / "lake"))
        self.files = 0

    def deliver(self, *texts):
        self.files += 1
        file = self.folder / f"{self.files:04d}.txt"
        file.write_text("\n".join(texts) + "\n")
        os.utime(file, (1_700_000_000 + self.files, 1_700_000_000 + self.files))


@pytest.fixture
def site(tmp_path):
    return Site(tmp_path)


def ids(spark, site, form):
    return sorted(r.message_id for r in ingest.stored_records(spark, site.lake, form).collect())


def test_each_message_is_stored_once_over_restarts(spark, site, form):
    site.deliver(message(1), message(2), message(1))
    site.deliver(message(2), message(3, day=2))
    ingest.drain(spark, site.where, site.lake, form)
    assert ids(spark, site, form) == ["m1", "m2", "m3"]
    ingest.drain(spark, site.where, site.lake, form)
    assert ids(spark, site, form) == ["m1", "m2", "m3"]
    site.deliver(message(3, day=2), message(4, day=1))
    ingest.drain(spark, site.where, site.lake, form)
    stored = ingest.stored_records(spark, site.lake, form)
    assert rows(stored, "message_id", "batch_id") == [("m1", 0), ("m2", 0), ("m3", 1), ("m4", 2)]


def test_late_messages_are_kept(spark, site, form):
    site.deliver(message(1, day=28))
    site.deliver(message(2, day=1))
    ingest.drain(spark, site.where, site.lake, form)
    assert ids(spark, site, form) == ["m1", "m2"]


def test_misfits_are_set_aside(spark, site, form):
    broken = ["not json", '{"test": "connection"}', '{"message_id": "x", "timestamp": "never", "farm": 1}', "[1]"]
    site.deliver(message(1, amount=5.34), *broken[:2])
    site.deliver(*broken[2:], message(2))
    ingest.drain(spark, site.where, site.lake, form)
    assert rows(ingest.stored_records(spark, site.lake, form), "message_id", "amount") == [("m1", 5.34), ("m2", 0.0)]
    assert [r[0] for r in rows(ingest.quarantined(spark, site.lake), ingest.MESSAGE)] == sorted(broken)


def test_a_repeated_batch_changes_nothing(spark, site, form):
    store = ingest.store_batch(site.lake, form)
    texts = [(message(1),), (message(2, day=2),), ("bad",)]
    batch = spark.createDataFrame(texts, "value string")
    store(spark.createDataFrame([(message(2, day=2),)], "value string"), 0)
    store(batch, 1)
    first = rows(ingest.stored_records(spark, site.lake, form))
    store(batch, 1)
    assert rows(ingest.stored_records(spark, site.lake, form)) == first and len(first) == 2
    assert ingest.quarantined(spark, site.lake).count() == 1


def test_batch_of_misfits_only(spark, site, form):
    site.deliver("bad")
    ingest.drain(spark, site.where, site.lake, form)
    assert ids(spark, site, form) == [] and ingest.quarantined(spark, site.lake).count() == 1


def test_running_ingest_flushes_at_its_interval(spark, site, form):
    site.deliver(message(1))
    running = ingest.ingest(spark, site.where, site.lake, form, every="1 second")
    try:
        running.processAllAvailable()
        site.deliver(message(2))
        running.processAllAvailable()
    finally:
        running.stop()
    assert ids(spark, site, form) == ["m1", "m2"]


def test_stream_equals_batch(spark, site, form):
    for day in range(1, 6):
        site.deliver(*[message(10 * day + i, day, i / 4) for i in range(10)])
    ingest.drain(spark, site.where, site.lake, form)
    batch = parse_json(spark.read.text(site.where.path), form.schema).drop("_corrupt")
    streamed = ingest.stored_records(spark, site.lake, form).select(*batch.columns)
    assert rows(streamed) == rows(batch) and streamed.count() == 50


def warehouse(spark, path, *cluster_by):
    return CommittedTable(spark, path("out"), export.MONTH, cluster_by)


def test_incremental_export_of_commits(spark, site, form, path):
    source, target = site.lake.records_table(spark), warehouse(spark, path, "farm")

    def run():
        return export.export_new_commits(source, target, "timestamp", "message_id", lambda df: df.drop(ingest.BUCKET))

    site.deliver(message(1), message(2))
    ingest.drain(spark, site.where, site.lake, form)
    assert run() == 1
    site.deliver(message(3))
    site.deliver(message(4, day=2))
    ingest.drain(spark, site.where, site.lake, form)
    ingest.compact_lake(spark, site.lake)
    assert run() == 2 and run() is None
    ingest.compact_lake(spark, site.lake)
    run()
    assert rows(target.read(), "message_id", "export_id", "month") == [
        ("m1", 1, "2024-01"), ("m2", 1, "2024-01"), ("m3", 4, "2024-01"), ("m4", 4, "2024-01"),
    ]


def test_export_keeps_undated_records_and_no_duplicates(spark, path):
    def row(i, dated=True):
        return (f"m{i}", "2024-01-05 10:00:00" if dated else None, i, 1.0)

    target = warehouse(spark, path, "farm")

    def deliver(*given):
        frame = spark.createDataFrame(given, "message_id string, at string, farm long, amount double")
        frame.select("message_id", F.to_timestamp("at").alias("timestamp"), "farm", "amount").coalesce(1).write.mode(
            "append"
        ).parquet(path("lake"))
        export.export_new_files(spark, path("lake"), target, path("cp"), "timestamp", "message_id")

    deliver(row(1), row(1), row(2, dated=False), row(2, dated=False))
    deliver(row(3, dated=False), row(4, dated=False))
    deliver(row(1), row(2, dated=False), row(5))
    assert rows(target.read(), "message_id", "export_id", "month") == [
        ("m1", 0, "2024-01"), ("m2", 0, "undated"), ("m3", 1, "undated"), ("m4", 1, "undated"), ("m5", 2, "2024-01"),
    ]


def test_export_widens_and_repeats_nothing_after_a_failure(spark, path, monkeypatch):
    target = warehouse(spark, path, "farm")

    def deliver(given, schema):
        spark.createDataFrame(given, schema).coalesce(1).write.mode("append").parquet(path("lake"))

    def run():
        export.export_new_files(spark, path("lake"), target, path("cp"), "at", "id")

    deliver([("a", "2024-01-05", 1, 10)], "id string, at string, farm long, amount int")
    run()
    old = target.version().number
    deliver([("b", "2024-02-05", 2, 2.5, "x")], "id string, at string, farm long, amount double, note string")
    publish = CommittedTable._publish

    def failing(self, change):
        monkeypatch.setattr(CommittedTable, "_publish", publish)
        raise RuntimeError("lost between write and commit")

    monkeypatch.setattr(CommittedTable, "_publish", failing)
    with pytest.raises(Exception, match="lost between write and commit"):
        run()
    assert target.version().number == old and target.read().count() == 1
    run()
    deliver([("c", "2024-02-06", 3, 7, None)], "id string, at string, farm long, amount long, note string")
    run()
    run()
    assert rows(target.read(), "id", "farm", "amount", "note", "month", "export_id") == [
        ("a", 1, 10.0, None, "2024-01", 0), ("b", 2, 2.5, "x", "2024-02", 1), ("c", 3, 7.0, None, "2024-02", 2),
    ]
    assert "note" not in target.read(version=old).columns and target.read(version=old).count() == 1
    assert dict(target.read(version=old).dtypes)["amount"] == "int"


class ReadIds:
    """Rows and files of the stored ids that batches have read."""

    def __init__(self, monkeypatch):
        self.rows, self.days, look = 0, [], ingest.stored_ids

        def counted(table, message_id, days, buckets):
            found = look(table, message_id, days, buckets)
            self.rows += found.count()
            self.days += days
            return found

        monkeypatch.setattr(ingest, "stored_ids", counted)


def test_a_batch_without_repeats_reads_no_stored_ids(spark, site, form, monkeypatch):
    store = ingest.store_batch(site.lake, form)
    read = ReadIds(monkeypatch)

    def batch(ids, day):
        return spark.createDataFrame([(message(i, day=day),) for i in ids], "value string")

    for k in range(4):
        store(batch(range(500 * k, 500 * (k + 1)), day=1 + k % 2), k)
    assert read.rows <= 5
    store(batch([3, 4, 9000], day=1), 4)
    # Those of two buckets, of the 1000 that the day has.
    assert 2 <= read.rows <= 60 and len(set(read.days)) <= 2
    ingest.compact_lake(spark, site.lake)
    store(batch([3, 4, 700, 9001], day=1), 5)
    stored = ingest.stored_records(spark, site.lake, form)
    assert stored.count() == 2003 == stored.select("message_id", "event_date").distinct().count()
    assert read.rows <= 150


def test_a_crash_between_bits_and_records_stores_all_once(spark, site, form, monkeypatch):
    store = ingest.store_batch(site.lake, form)
    batch = spark.createDataFrame([(message(1),), (message(2),)], "value string")
    publish = CommittedTable._publish

    def failing(self, change):
        if self.path.endswith("records"):
            raise RuntimeError("lost")
        return publish(self, change)

    monkeypatch.setattr(CommittedTable, "_publish", failing)
    with pytest.raises(RuntimeError):
        store(batch, 0)
    monkeypatch.setattr(CommittedTable, "_publish", publish)
    assert ids(spark, site, form) == []
    store(batch, 0)
    store(batch, 1)
    assert ids(spark, site, form) == ["m1", "m2"]


def test_compaction_packs_the_files_of_each_day(spark, site, form):
    store = ingest.store_batch(site.lake, form)
    for k in range(12):
        texts = [(message(100 * k + i, day=1 + (i % 3 == 0)),) for i in range(20)]
        store(spark.createDataFrame(texts, "value string"), k)
    table = site.lake.records_table(spark)
    before, files = rows(table.read()), table.files()
    assert files.count() == 24
    sizes = {r["slice"]: r["bytes"] for r in files.groupBy("slice").agg(F.sum("bytes").alias("bytes")).collect()}
    target = max(sizes.values()) // 3 + 1
    ingest.compact_lake(spark, site.lake, target)
    live = {r["slice"]: r["n"] for r in table.files().groupBy("slice").agg(F.count("*").alias("n")).collect()}
    assert live == {day: -(-size // target) for day, size in sizes.items()}
    assert rows(table.read()) == before
    assert site.lake.seen_table(spark).files().count() < 12
    ingest.compact_lake(spark, site.lake)
    assert site.lake.seen_table(spark).files().count() == 1 and rows(table.read()) == before
    store(spark.createDataFrame([(message(5, day=1),), (message(5000, day=1),)], "value string"), 12)
    assert table.read().count() == len(before) + 1


def test_watermark_removes_duplicates_in_the_stream(spark, site, form, path):
    site.deliver(message(1), message(1), message(2))
    site.deliver(message(2), message(3))
    parsed = parse_json(read_messages(spark, site.where), form.schema).drop("_corrupt")
    unique = ingest.drop_redelivered(parsed, "message_id", "timestamp", "30 days")
    ingest.plain_file_sink(unique, path("out"), path("cp")).awaitTermination()
    stored = spark.read.schema(parsed.schema).parquet(path("out"))
    assert rows(stored, "message_id") == [("m1",), ("m2",), ("m3",)]


def test_plain_sink_partitions(spark, site, form, path):
    site.deliver(message(1), message(2, day=2))
    parsed = parse_json(read_messages(spark, site.where), form.schema).drop("_corrupt")
    dated = parsed.withColumn("day", F.to_date("timestamp"))
    ingest.plain_file_sink(dated, path("out"), path("cp"), ["day"]).awaitTermination()
    assert spark.read.parquet(path("out")).select("day").distinct().count() == 2


def test_topic_options():
    options = Topic("broker:9092", "records", max_records=100).options()
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "records"
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("50", "10s")
    assert options["maxOffsetsPerTrigger"] == "100"
    assert "minOffsetsPerTrigger" not in Topic("b", "t", min_records=None).options()


def test_records_and_bitmaps_are_compacted_side_by_side(spark, path, monkeypatch):
    both, asked = threading.Barrier(2), []

    def compact(self, target_bytes, fold=None):
        both.wait(20)
        asked.append((self.path.rsplit("/", 1)[-1], target_bytes, fold is not None))

    monkeypatch.setattr(ingest.CommittedTable, "compact", compact)
    ingest.compact_lake(spark, ingest.Lake(path("lake")), 10)
    assert sorted(asked) == [("records", 10, False), ("seen", 10, True)]
