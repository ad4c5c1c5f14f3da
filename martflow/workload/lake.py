"""Quality checks, sinks read back, and streams drained."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.bindings import agri
from martflow.bindings.testdata import MEASURE, Binding
from martflow.functions import aggregate as agg
from martflow.functions import scalar
from martflow.operators import conform, quality
from martflow.plans import staging, star
from martflow.plans.refresh import Measure, Rollup, compact_state, refresh
from martflow.sinks import files as file_sinks
from martflow.sinks import tables as table_sinks
from martflow.sinks.committed import CommittedTable
from martflow.sources import files as file_sources
from martflow.sources.messages import Landing, read_messages
from martflow.streaming import export, ingest
from martflow.workload.ansi import sql, total
from martflow.workload.registry import query, table_name
from martflow.workload.scalars import LINE, LINE_SQL
from martflow.workspace import materialise, new_path

# Quality


@query(
    "dq_unique",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING COUNT(*) > 1""",
)
def dq_unique(b: Binding) -> DataFrame:
    return quality.duplicated_keys(b.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_not_null",
    sql(
        """SELECT 'not_null' AS check_name, 'ph_level' AS column_name, 'warn' AS severity,
        COUNT(*) FILTER (WHERE ph_level IS NULL) AS violations FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id
        UNION ALL SELECT 'not_null', 'farm_id', 'error', COUNT(*) FILTER (WHERE farm_id IS NULL) FROM farms
        UNION ALL SELECT 'unique', 'farm_location', 'warn', COUNT(*) FROM (SELECT farm_location FROM farms
          WHERE farm_location IS NOT NULL GROUP BY farm_location HAVING COUNT(*) > 1)"""
    ),
)
def dq_not_null(b: Binding) -> DataFrame:
    return quality.run_checks(
        b.farms.join(b.soil, "farm_id", "left"),
        [
            quality.NotNull("ph_level"),
            quality.NotNull("farm_id", severity="error"),
            quality.Unique("farm_location"),
        ],
    )


@query(
    "dq_accepted",
    sql(
        """SELECT 'accepted' AS check_name, 'Soil_Type' AS column_name, 'warn' AS severity,
        COUNT(*) FILTER (WHERE "Soil_Type" NOT IN ('Clay', 'Sandy', 'Silt')) AS violations FROM raw
        UNION ALL SELECT 'accepted', 'Crop_Type', 'warn', COUNT(*) FILTER (WHERE "Crop_Type" NOT IN ('SMALL', 'LARGE'))
          FROM raw
        UNION ALL SELECT 'in_range', 'Soil_Fertility', 'warn',
          COUNT(*) FILTER (WHERE NOT "Soil_Fertility" BETWEEN 1 AND 5) FROM raw"""
    ),
)
def dq_accepted(b: Binding) -> DataFrame:
    return quality.run_checks(
        b.raw,
        [
            quality.Accepted("Soil_Type", ["Clay", "Sandy", "Silt"]),
            quality.Accepted("Crop_Type", ["SMALL", "LARGE"]),
            quality.InRange("Soil_Fertility", 1, 5),
        ],
    )


def dictionary_sql() -> str:
    shown = ["Farm_Type", "Crop_Type", "Yield_Unit", "Soil_Type", "Irrigation_Method", "Fertilizer_Type",
             "Pesticide_Type", "Certification", "Order_Status"]
    parts = [
        f"""SELECT 'accepted' AS check_name, '{name}' AS column_name, 'warn' AS severity, COUNT(*) FILTER (
        WHERE "{name}" NOT IN ({", ".join(f"'{v}'" for v in agri.ACCEPTED_VALUES[name])})) AS violations FROM raw"""
        for name in shown
    ] + [
        f"""SELECT 'in_range', '{name}', 'warn', COUNT(*) FILTER (WHERE "{name}" NOT BETWEEN {low} AND {high}) FROM raw"""
        for name, (low, high) in agri.SCALES.items()
    ]
    return sql(" UNION ALL ".join(parts))


@query("dq_dictionary", dictionary_sql())
def dq_dictionary(b: Binding) -> DataFrame:
    """Accepted values and scales of the data dictionary, in one pass."""
    return quality.run_checks(b.raw, agri.dictionary_checks(b.raw.columns))


KEYED = {
    "stg_weather": "weather", "stg_soil": "soil", "stg_harvest": "harvest", "stg_production": "production",
    "stg_yield": "yields", "stg_sustainability": "sustainability",
}


@query(
    "dq_keys",
    sql(
        " UNION ALL ".join(
            f"""SELECT 'unique' AS check_name, '{staging.SEED_KEYS[view]}' AS column_name, 'error' AS severity,
            COUNT({staging.SEED_KEYS[view]}) - COUNT(DISTINCT {staging.SEED_KEYS[view]}) AS violations FROM {table}
            UNION ALL SELECT 'not_null', '{staging.SEED_KEYS[view]}', 'error',
            COUNT(*) FILTER (WHERE {staging.SEED_KEYS[view]} IS NULL) FROM {table}"""
            for view, table in KEYED.items()
        )
    ),
)
def dq_keys(b: Binding) -> DataFrame:
    """Keys of the staging views."""
    b.shared()
    return conform.union_all(
        [quality.run_checks(getattr(b, table), staging.key_checks(view, "error")) for view, table in KEYED.items()]
    )


@query(
    "dq_contract",
    """SELECT column_name, expected_type, found_type, status, n_rows FROM (VALUES
        ('n_nationkey', 'int', 'int', 'ok'), ('n_name', 'bigint', 'string', 'type differs'),
        ('n_comment', 'string', NULL, 'missing'), ('n_regionkey', NULL, 'int', 'unexpected'))
        AS t(column_name, expected_type, found_type, status), (SELECT COUNT(*) AS n_rows FROM nation)""",
)
def dq_contract(b: Binding) -> DataFrame:
    nation = b.table("nation")
    report = quality.contract_report(
        nation, {"n_nationkey": "int", "n_name": "bigint", "n_comment": "string"}
    )
    return report.withColumn("n_rows", nation.agg(F.count(F.lit(1))).scalar())


@query(
    "dq_reconcile",
    """SELECT source_rows, target_rows, source_rows - target_rows AS difference
        FROM (SELECT COUNT(*) AS source_rows FROM lineitem), (SELECT COUNT(*) AS target_rows FROM lineitem JOIN orders
        ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P')""",
)
def dq_reconcile(b: Binding) -> DataFrame:
    orders = b.table("orders").where("o_orderstatus <> 'P'")
    loaded = b.table("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.reconcile(b.table("lineitem"), loaded)


# In the target the first lines of a few orders are changed, lost or repeated, by the order's remainder.
LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(
    "dq_reconcile_content",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_source,
        CASE l_orderkey % 4 WHEN 3 THEN 0 WHEN 0 THEN 2 * COUNT(*) ELSE COUNT(*) END AS n_target,
        CASE l_orderkey % 4 WHEN 3 THEN 'missing' WHEN 0 THEN 'count' ELSE 'changed' END AS kind
        FROM lineitem WHERE l_orderkey <= 40 AND l_linenumber = 1 GROUP BY l_orderkey, l_linenumber""",
)
def dq_reconcile_content(b: Binding) -> DataFrame:
    """The keys in which what was loaded differs from all lines: changed, lost and repeated ones."""
    lines, case = b.table("lineitem"), F.col("l_orderkey") % 4
    at = (F.col("l_linenumber") == 1) & (F.col("l_orderkey") <= 40)
    tax = F.when(at & case.isin(1, 2), F.col("l_tax") + 0.01).otherwise(F.col("l_tax"))
    loaded = lines.withColumn("l_tax", tax).where(~(at & (case == 3)))
    loaded = materialise(loaded.unionByName(lines.where(at & (case == 0))), "loaded")
    return quality.differing_keys(lines, loaded, LINE_KEY)


@query(
    "profile",
    sql(
        """SELECT column_name, column_type, n_rows, n_nulls FROM (
          SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE ph_level IS NULL) AS missing
          FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id) AS t,
          LATERAL (VALUES ('farm_id', 'bigint', 0), ('ph_level', 'double', missing),
          ('farm_name', 'string', 0)) AS v(column_name, column_type, n_nulls)"""
    ),
)
def profile(b: Binding) -> DataFrame:
    return quality.profile(b.farms.join(b.soil, "farm_id", "left").select("farm_id", "ph_level", "farm_name"))


# Sinks, read back


@query(
    "scan_drifting",
    f"""SELECT {LINE_SQL}, l_returnflag,
        CASE l_returnflag WHEN 'R' THEN 0 ELSE l_quantity END AS amount FROM lineitem""",
)
def scan_drifting(b: Binding) -> DataFrame:
    """Files that hold the amount as an integer, as a floating-point number, or not at all."""
    path = new_path(b.spark, "drift")
    lines = b.table("lineitem").select(*LINE, "l_returnflag", "l_quantity")
    shapes = {
        "A": lines.withColumn("amount", F.col("l_quantity").cast("bigint")),
        "N": lines.withColumn("amount", F.col("l_quantity")),
        "R": lines,
    }
    for flag, frame in shapes.items():
        frame.where(F.col("l_returnflag") == flag).drop("l_quantity").write.parquet(f"{path}/{flag}")
    return file_sources.read_drifting(b.spark, path, ["amount"])


@query(
    "scan_drifting_partitioned",
    f"""SELECT {LINE_SQL}, l_returnflag, l_linestatus,
        CASE l_returnflag WHEN 'R' THEN 0 ELSE l_quantity END AS amount FROM lineitem""",
)
def scan_drifting_partitioned(b: Binding) -> DataFrame:
    """Drifting files in partition directories, whose columns stay."""
    path = new_path(b.spark, "drift-partitioned")
    lines = b.table("lineitem").select(*LINE, "l_returnflag", "l_linestatus", "l_quantity")
    shapes = {
        "A": lines.withColumn("amount", F.col("l_quantity").cast("bigint")),
        "N": lines.withColumn("amount", F.col("l_quantity")),
        "R": lines,
    }
    for flag, frame in shapes.items():
        own = frame.where(F.col("l_returnflag") == flag).drop("l_quantity")
        own.write.mode("append").partitionBy("l_linestatus").parquet(path)
    return file_sources.read_drifting(b.spark, path, ["amount"])


@query(
    "write_star",
    sql(
        """SELECT 'dim_crop' AS name, COUNT(*) AS n_rows FROM (SELECT DISTINCT "Crop_ID", "Crop_Type", "Crop_Variety"
          FROM raw) UNION ALL SELECT 'dim_farm', COUNT(*) FROM (SELECT DISTINCT "Farm_ID" FROM raw)
        UNION ALL SELECT 'fact_crop_yield', COUNT(*) FROM raw
        UNION ALL SELECT 'fact_farm_production', COUNT(*) FROM raw
        UNION ALL SELECT 'fact_sustainability', COUNT(*) FROM raw"""
    ),
)
def write_star(b: Binding) -> DataFrame:
    written = star.write_star(b.stored_raw(), new_path(b.spark, "star"))
    shown = [name for name in written if name.startswith("fact_") or name in ("dim_farm", "dim_crop")]
    return conform.union_all(
        [
            b.spark.read.parquet(written[name])
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("name"), "n_rows")
            for name in shown
        ]
    )


@query(
    "partitioned_roundtrip",
    f"""SELECT CAST(YEAR(l_shipdate) AS INTEGER) AS year, CAST(MONTH(l_shipdate) AS INTEGER) AS month, COUNT(*) AS n,
        {total('l_quantity')} AS quantity FROM lineitem GROUP BY 1, 2""",
)
def partitioned_roundtrip(b: Binding) -> DataFrame:
    path = new_path(b.spark, "partitioned")
    dated = b.table("lineitem").withColumns({"year": F.year("l_shipdate"), "month": F.month("l_shipdate")})
    file_sinks.write_partitioned(dated, path, ["year", "month"], ["l_suppkey", "l_partkey"])
    stored = file_sources.read_partitioned(b.spark, path)
    return stored.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), agg.total("l_quantity", MEASURE).alias("quantity")
    )


@query(
    "partition_overwrite",
    """SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS year, o_orderkey,
        CASE WHEN YEAR(o_orderdate) >= 2000 THEN 'revised' ELSE 'first' END AS version FROM orders""",
)
def partition_overwrite(b: Binding) -> DataFrame:
    """A second write that replaces the partitions it holds and leaves the others."""
    path = new_path(b.spark, "overwrite")
    orders = b.table("orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    file_sinks.write_partitioned(orders.withColumn("version", F.lit("first")), path, ["year"])
    revised = orders.where("year >= 2000").withColumn("version", F.lit("revised"))
    file_sinks.write_partitioned(revised, path, ["year"])
    return file_sources.read_partitioned(b.spark, path)


def stored_table(b: Binding, table: str, path: str) -> DataFrame:
    """The files of an external table; the catalog entry itself is given up."""
    schema = b.spark.table(table).schema
    b.spark.sql(f"DROP TABLE {table}")
    return b.spark.read.schema(schema).parquet(path)


@query(
    "append_evolve",
    sql(
        """SELECT farm_id, crop_id, planting_date, actual_yield, l_linestatus AS status,
        CASE WHEN l_linestatus = 'O' THEN crop_type END AS crop_type,
        STRFTIME(planting_date, '%Y-%m') AS planting_month
        FROM (SELECT l_suppkey AS farm_id, l_partkey AS crop_id, CAST(o_orderdate AS DATE) AS planting_date,
              l_quantity * (1 - l_discount) AS actual_yield, l_linestatus, p_type AS crop_type FROM lines)"""
    ),
)
def append_evolve(b: Binding) -> DataFrame:
    """Two appends to a table partitioned by month; the second brings a column the table did not have."""
    table, path = table_name("evolve"), new_path(b.spark, "evolve")
    lines = b.lines.select(
        F.col("l_suppkey").alias("farm_id"),
        F.col("l_partkey").alias("crop_id"),
        F.col("o_orderdate").cast("date").alias("planting_date"),
        (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("actual_yield"),
        F.col("l_linestatus").alias("status"),
        F.col("p_type").alias("crop_type"),
    )
    for part in (lines.where("status <> 'O'").drop("crop_type"), lines.where("status = 'O'")):
        table_sinks.append_evolving(part, table, "planting_date", ["farm_id", "crop_id"], path)
    return stored_table(b, table, path)


@query(
    "create_if_absent",
    "SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY o_custkey",
)
def create_if_absent(b: Binding) -> DataFrame:
    """The second creation finds the table and does nothing."""
    table, path = table_name("absent"), new_path(b.spark, "absent")
    counts = b.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    table_sinks.create_if_absent(b.spark, table, lambda: counts, path)
    table_sinks.create_if_absent(b.spark, table, lambda: b.table("nation"), path)
    return stored_table(b, table, path)


@query(
    "replace_table",
    "SELECT o_orderstatus, COUNT(*) AS n_orders FROM orders GROUP BY o_orderstatus",
)
def replace_table(b: Binding) -> DataFrame:
    """A table replaced by a later result, through a named intermediate result that is dropped."""
    table, path = table_name("replace"), new_path(b.spark, "replace")
    table_sinks.replace_table(b.table("region"), table, path)
    counts = b.table("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    with table_sinks.temporary_view(counts, table_name("view")) as view:
        table_sinks.replace_table(b.spark.table(view), table, path)
    return stored_table(b, table, path)


@query("seed_csv_roundtrip", sql("SELECT crop_id, crop_name, crop_type, growing_season, water_needs FROM crops"))
def seed_csv_roundtrip(b: Binding) -> DataFrame:
    from martflow.bindings.agri import seed_schema

    path = new_path(b.spark, "seed")
    schema = seed_schema("seed_crop")
    b.crops.select(*schema.names).write.csv(path, header=True)
    return file_sources.read_seed(b.spark, path, schema)


@query("messy_csv", sql("SELECT crop_id, crop_name, crop_type, growing_season, water_needs FROM crops"))
def messy_csv(b: Binding) -> DataFrame:
    """CSV lines that end in carriage returns and are followed by blank ones."""
    from martflow.bindings.agri import seed_schema

    path = new_path(b.spark, "messy")
    schema = seed_schema("seed_crop")
    line = F.concat(F.concat_ws(",", *[F.col(c).cast("string") for c in schema.names]), F.lit("\r\n  \r"))
    b.crops.select(line).write.text(path)
    return file_sources.read_messy_csv(b.spark, path, schema)


# Messages and streams

MESSAGE = (
    T.StructType()
    .add("message_id", T.StringType())
    .add("timestamp", T.TimestampType())
    .add("user_id", T.LongType())
    .add("event_type", T.StringType())
    .add("value", T.DoubleType())
    .add("props", T.StringType())
)
FORM = ingest.MessageFormat(MESSAGE)


def event_records(b: Binding) -> DataFrame:
    return b.table("events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "user_id", "event_type", "value", "props",
    )


def event_messages(b: Binding) -> DataFrame:
    return file_sinks.as_messages(event_records(b), "message_id")


@query(
    "json_publish",
    """SELECT CAST(event_id AS VARCHAR) AS key, '{"event_id":' || event_id || ',"user_id":' || user_id
        || ',"event_type":"' || event_type || '"}' AS value FROM events""",
)
def json_publish(b: Binding) -> DataFrame:
    return file_sinks.as_messages(b.table("events").select("event_id", "user_id", "event_type"), "event_id")


@query(
    "json_parse",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent FROM events""",
)
def json_parse(b: Binding) -> DataFrame:
    props = T.StructType.fromDDL("k long, absent string")
    return conform.parse_json(b.table("events").select("event_id", "props"), props, "props").select(
        "event_id", "k", "absent"
    )


EVENTS_SQL = "SELECT CAST(event_id AS VARCHAR) AS message_id, user_id, event_type, value, props FROM events"


def landed(b: Binding, *parts: DataFrame) -> Landing:
    """A landing directory to which message batches have been written one after the other."""
    path = new_path(b.spark, "landing")
    for part in parts:
        file_sinks.publish(part, path)
    return Landing(path, max_files=4)


def new_lake(b: Binding) -> ingest.Lake:
    return ingest.Lake(new_path(b.spark, "lake"))


def shown(records: DataFrame) -> DataFrame:
    return records.select("message_id", "user_id", "event_type", "value", "props")


@query("stream_ingest", EVENTS_SQL)
def stream_ingest(b: Binding) -> DataFrame:
    """All messages, drained in two runs on one checkpoint."""
    messages = event_messages(b)
    error = F.get_json_object("value", "$.event_type") == "error"
    where, lake = landed(b, messages.where(~error)), new_lake(b)
    ingest.drain(b.spark, where, lake, FORM)
    file_sinks.publish(messages.where(error), where.path)
    ingest.drain(b.spark, where, lake, FORM)
    return shown(ingest.stored_records(b.spark, lake, FORM))


@query("stream_dedup", EVENTS_SQL)
def stream_dedup(b: Binding) -> DataFrame:
    """All messages delivered twice, partly within one batch and partly in later ones, stored once."""
    messages = event_messages(b)
    where, lake = landed(b, messages, messages), new_lake(b)
    ingest.drain(b.spark, where, lake, FORM)
    file_sinks.publish(messages, where.path)
    ingest.drain(b.spark, where, lake, FORM)
    return shown(ingest.stored_records(b.spark, lake, FORM))


@query(
    "stream_quarantine",
    """SELECT 'not json ' || event_id AS value FROM events
        UNION ALL SELECT '{"test":"connection ' || event_id || '"}' FROM events""",
)
def stream_quarantine(b: Binding) -> DataFrame:
    """Texts that are no JSON and messages without an id, set aside while the sound ones are stored."""
    events = b.table("events")
    broken = events.select(F.concat(F.lit("not json "), F.col("event_id").cast("string")).alias("value"))
    foreign = events.select(
        F.to_json(F.struct(F.concat(F.lit("connection "), F.col("event_id").cast("string")).alias("test"))).alias(
            "value"
        )
    )
    where, lake = landed(b, event_messages(b), broken, foreign), new_lake(b)
    ingest.drain(b.spark, where, lake, FORM)
    return ingest.quarantined(b.spark, lake).select(F.col(ingest.MESSAGE).alias("value"))


@query(
    "stream_incremental_export",
    """SELECT event_type, STRFTIME(ts, '%Y-%m') AS month, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,4))) AS DOUBLE)
        AS total FROM events GROUP BY 1, 2""",
)
def stream_incremental_export(b: Binding) -> DataFrame:
    """Two rounds of ingest, each followed by an export of what is new."""
    messages = event_messages(b)
    error = F.get_json_object("value", "$.event_type") == "error"
    where, lake = landed(b, messages.where(~error)), new_lake(b)
    target = CommittedTable(b.spark, new_path(b.spark, "export"), export.MONTH, ["user_id"])

    def round_trip() -> None:
        ingest.drain(b.spark, where, lake, FORM)
        export.export_new_commits(
            lake.records_table(b.spark), target, "timestamp", "message_id",
            lambda df: df.select("message_id", "timestamp", "user_id", "event_type", "value"),
        )

    round_trip()
    file_sinks.publish(messages.where(error), where.path)
    round_trip()
    exported = target.read()
    return exported.groupBy("event_type", F.date_format("timestamp", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), agg.total("value", "decimal(18,4)").alias("total")
    )


@query(
    "export_evolving",
    """SELECT event_id, user_id, STRFTIME(ts, '%Y-%m') AS month,
        CASE user_id % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(FLOOR(value) AS DOUBLE) ELSE value END AS value,
        CASE WHEN user_id % 3 = 2 THEN event_type END AS event_type FROM events""",
)
def export_evolving(b: Binding) -> DataFrame:
    """A lake whose later files bring a column, then a wider type and another column, exported in three runs.

    What the second run was about to commit is lost once, and it is run again.
    """
    lake, checkpoint = new_path(b.spark, "evolving"), new_path(b.spark, "evolving-checkpoint")
    target = CommittedTable(b.spark, new_path(b.spark, "evolving-export"), export.MONTH, ["user_id", "event_id"])
    events = b.table("events").select("event_id", "user_id", "ts", "value", "event_type")
    waves = [
        events.drop("value", "event_type"),
        events.drop("event_type").withColumn("value", F.floor("value").cast("int")),
        events,
    ]
    for k, wave in enumerate(waves):
        wave.where(F.col("user_id") % 3 == k).write.mode("append").parquet(lake)
        if k == 1:
            target.prepare(wave.withColumn(export.MONTH, F.lit("lost")), "files", k)  # written, and never published
        export.export_new_files(b.spark, lake, target, checkpoint, "ts", "event_id")
    return target.read().select("event_id", "user_id", "month", "value", "event_type")


@query("lake_compacted", EVENTS_SQL)
def lake_compacted(b: Binding) -> DataFrame:
    """All messages, delivered in many small batches, partly twice, and put together in between."""
    messages = event_messages(b)
    part = F.pmod(F.xxhash64("key"), F.lit(4))
    where, lake = landed(b, *[messages.where(part == k) for k in range(4)]), new_lake(b)
    one_file = Landing(where.path, max_files=1)
    ingest.drain(b.spark, one_file, lake, FORM)
    ingest.compact_lake(b.spark, lake)
    file_sinks.publish(messages.where(part < 2), where.path)
    ingest.drain(b.spark, one_file, lake, FORM)
    ingest.compact_lake(b.spark, lake)
    lake.records_table(b.spark).vacuum()
    return shown(ingest.stored_records(b.spark, lake, FORM))


@query(
    "clustered_lookup",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, STRFTIME(l_shipdate, '%Y-%m') AS month FROM lineitem
        WHERE l_suppkey = 7 AND l_partkey BETWEEN 1 AND 150""",
)
def clustered_lookup(b: Binding) -> DataFrame:
    """A range of keys, read from the files of a table that can hold them."""
    table = CommittedTable(b.spark, new_path(b.spark, "clustered"), "month", ["l_suppkey", "l_partkey"])
    month = F.date_format("l_shipdate", "yyyy-MM").alias("month")
    table.append(b.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", month))
    return table.read(within={"l_suppkey": (7, 7), "l_partkey": (1, 150)})


@query(
    "rollup_refreshed",
    """SELECT l_returnflag, l_linestatus,
        CAST(SUM(CAST(ROUND(l_quantity * 10000) AS BIGINT)) AS DOUBLE) / 10000 / COUNT(l_quantity) AS avg_l_quantity,
        CAST(SUM(CAST(ROUND(l_discount * 10000) AS BIGINT)) AS DOUBLE) / 10000 / COUNT(l_discount) AS avg_l_discount,
        COUNT(DISTINCT l_suppkey) AS n_l_suppkey FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def rollup_refreshed(b: Binding) -> DataFrame:
    """Means and distinct suppliers, kept up to date over three commits of which each refresh reads the last alone."""
    lines = b.table("lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_suppkey", F.date_format("l_shipdate", "yyyy").alias("year")
    )
    source = CommittedTable(b.spark, new_path(b.spark, "rollup-source"), "year", ["l_suppkey"])
    measures = {m: Measure(F.col(m)) for m in ("l_quantity", "l_discount")}
    rollup = Rollup(["l_returnflag", "l_linestatus"], measures, distinct="l_suppkey")
    state = rollup.state_table(b.spark, new_path(b.spark, "rollup-state"), "year")
    part = F.year(F.to_date(F.col("year"), "yyyy")) % 3
    for k in range(3):
        source.append(lines.where(part == k))
        refresh(source, state, rollup)
    compact_state(state, rollup)
    return rollup.result(state.read())


@query(
    "scan_indexed",
    f"""SELECT {LINE_SQL}, CASE l_returnflag WHEN 'R' THEN 0 ELSE l_quantity END AS amount FROM lineitem""",
)
def scan_indexed(b: Binding) -> DataFrame:
    """Drifting files scanned twice; the second scan opens the footers of the files that have come since."""
    path, index = new_path(b.spark, "drift-indexed"), new_path(b.spark, "drift-index")
    lines = b.table("lineitem").select(*LINE, "l_returnflag", "l_quantity")
    shapes = {
        "A": lines.withColumn("amount", F.col("l_quantity").cast("bigint")),
        "N": lines.withColumn("amount", F.col("l_quantity")),
        "R": lines,
    }
    for flag, frame in shapes.items():
        frame.where(F.col("l_returnflag") == flag).drop("l_quantity", "l_returnflag").write.parquet(f"{path}/{flag}")
        found = file_sources.read_drifting(b.spark, path, ["amount"], index=index)
    return found


@query(
    "rescued_values",
    f"""SELECT {LINE_SQL}, CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN NULL
            WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS amount,
        CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'n/a' END AS rescued FROM lineitem""",
)
def rescued_values(b: Binding) -> DataFrame:
    """Drifting files, some with texts that are no numbers: those are kept, and are no measured zeros."""
    path = new_path(b.spark, "rescued")
    lines = b.table("lineitem").select(*LINE, "l_returnflag", "l_quantity")
    text = F.when(F.col("l_linenumber") == 1, "n/a").otherwise(F.col("l_quantity").cast("string"))
    shapes = {"A": lines.withColumn("amount", F.col("l_quantity").cast("bigint")), "N": lines.withColumn("amount", text), "R": lines}
    for flag, frame in shapes.items():
        frame.where(F.col("l_returnflag") == flag).drop("l_quantity", "l_returnflag").write.parquet(f"{path}/{flag}")
    found = file_sources.read_drifting(b.spark, path, ["amount"], rescued="kept")
    return found.select(*LINE, "amount", F.col("kept")["amount"].alias("rescued"))


@query("stream_file_sink", EVENTS_SQL)
def stream_file_sink(b: Binding) -> DataFrame:
    """The plain exactly-once file sink."""
    where, path, checkpoint = landed(b, event_messages(b)), new_path(b.spark, "sink"), new_path(b.spark, "sink-cp")
    parsed = conform.parse_json(read_messages(b.spark, where), MESSAGE).drop("_corrupt")
    ingest.plain_file_sink(parsed, path, checkpoint).awaitTermination()
    return shown(b.spark.read.schema(parsed.schema).parquet(path))


@query(
    "message_days",
    """SELECT CAST(ts AS DATE) AS event_day, COUNT(*) AS n FROM events GROUP BY 1""",
)
def message_days(b: Binding) -> DataFrame:
    day = scalar.iso_date("timestamp").alias("event_day")
    return event_records(b).groupBy(day).agg(F.count(F.lit(1)).alias("n"))
