"""Small lookups, catalog tables, fallbacks, severities and whole mart runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.bindings import agri
from martflow.bindings.testdata import Binding
from martflow.functions import scalar
from martflow.operators import conform, quality
from martflow.plans import marts, run, staging, star
from martflow.sinks import files as file_sinks
from martflow.sinks import tables as table_sinks
from martflow.sources import catalog
from martflow.sources import files as file_sources
from martflow.workload.ansi import sql
from martflow.workload.lake import KEYED, stored_table
from martflow.workload.registry import SQL, query, table_name
from martflow.workload.relational import AS_OF_YEAR
from martflow.workload.tables import RECORDS, crop_sql, farm_sql
from martflow.workspace import materialise, new_path

# Sources

CLIMATES = [(0, "hot"), (1, "mild"), (2, "wet"), (3, "mild"), (4, "dry")]


@query(
    "scan_rows",
    f"""SELECT n_name, climate FROM nation LEFT JOIN (VALUES {", ".join(map(str, CLIMATES))}) AS c(regionkey, climate)
        ON n_regionkey = regionkey""",
)
def scan_rows(b: Binding) -> DataFrame:
    """A lookup given as rows next to a table."""
    climates = file_sources.read_rows(b.spark, CLIMATES, "n_regionkey int, climate string")
    return b.table("nation").join(climates, "n_regionkey", "left").select("n_name", "climate")


@query(
    "catalog_contract",
    "SELECT s_nationkey, COUNT(*) AS n_rows FROM supplier GROUP BY s_nationkey",
)
def catalog_contract(b: Binding) -> DataFrame:
    """A catalog table that has the columns of its contract."""
    table, path = table_name("contract"), new_path(b.spark, "contract")
    table_sinks.replace_table(b.table("supplier"), table, path)
    catalog.source(b.spark, table, ["s_suppkey", "s_nationkey", "s_acctbal"])
    return stored_table(b, table, path).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "model_reference",
    """SELECT n_name, COUNT(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_acctbal > 0 GROUP BY n_name""",
)
def model_reference(b: Binding) -> DataFrame:
    """Results under names, on which another named result is built."""
    customers, nations = table_name("customers"), table_name("nations")
    catalog.as_views({customers: b.table("customer").where("c_acctbal > 0"), nations: b.table("nation")})
    solvent = (
        f"SELECT n_name, COUNT(*) AS n_customers FROM {customers} JOIN {nations} ON c_nationkey = n_nationkey "
        "GROUP BY n_name"
    )
    return catalog.view_of(b.spark, table_name("solvent"), lambda: b.spark.sql(solvent))


@query(
    "source_fallback",
    "SELECT s_suppkey AS key, 'fallback' AS origin FROM supplier UNION ALL SELECT c_custkey, 'source' FROM customer",
)
def source_fallback(b: Binding) -> DataFrame:
    """A source that is not there gives way to its default, one that is there does not."""

    def picked(path: str) -> DataFrame:
        return file_sources.read_or_default(
            lambda: b.spark.read.parquet(path).select(F.col("c_custkey").alias("key"), F.lit("source").alias("origin")),
            lambda: b.table("supplier").select(F.col("s_suppkey").alias("key"), F.lit("fallback").alias("origin")),
        )

    return picked(new_path(b.spark, "nowhere")).unionByName(picked(f"{b.directory}/customer.parquet"))


@query(
    "sources_present",
    """SELECT 'orders' AS name, COUNT(*) > 0 AS present, COUNT(*) AS n_rows FROM orders
        UNION ALL SELECT 'absent', FALSE, NULL""",
)
def sources_present(b: Binding) -> DataFrame:
    paths = {"orders": f"{b.directory}/orders.parquet", "absent": new_path(b.spark, "absent-source")}
    present = file_sources.data_present(b.spark, paths)

    def told(name: str, there: bool) -> DataFrame:
        if not there:
            return file_sources.read_rows(b.spark, [(name, False, None)], "name string, present boolean, n_rows long")
        counted = b.spark.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("n_rows"))
        return counted.select(F.lit(name).alias("name"), F.lit(True).alias("present"), "n_rows")

    return conform.union_all([told(name, there) for name, there in present.items()])


@query(
    "table_of_file",
    "SELECT 'orders' AS table_name, o_orderstatus, COUNT(*) AS n_rows FROM orders GROUP BY o_orderstatus",
)
def table_of_file(b: Binding) -> DataFrame:
    """Rows by the table whose directory holds their file."""
    path = f"{new_path(b.spark, 'named')}/orders"
    file_sinks.write_partitioned(b.table("orders").select("o_orderkey", "o_orderstatus"), path, ["o_orderstatus"])
    stored = file_sources.read_partitioned(b.spark, path)
    named = stored.select(scalar.table_of_path("_metadata.file_path").alias("table_name"), "o_orderstatus")
    return named.groupBy("table_name", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query("json_inferred", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_inferred(b: Binding) -> DataFrame:
    """Texts parsed with the schema of the first of them."""
    events = b.table("events").select("event_id", "props")
    sample = events.where("props IS NOT NULL").orderBy("event_id").first()
    schema = conform.infer_json_schema(b.spark, sample["props"])
    return conform.parse_json(events, schema, "props").select("event_id", "k")


@query(
    "json_inferred_all",
    """SELECT event_id, CASE WHEN event_id % 4 = 1 THEN value ELSE CAST(json_extract(props, '$.k') AS DOUBLE) END AS k,
        CASE WHEN event_id % 4 = 2 THEN event_type END AS kind,
        CASE WHEN event_id % 4 = 3 THEN CAST(user_id AS VARCHAR) WHEN event_id % 4 = 2 THEN event_type END AS mixed
        FROM events""",
)
def json_inferred_all(b: Binding) -> DataFrame:
    """Texts parsed with a schema that all of them were looked at for: keys that come later, and types that widen."""
    events = b.table("events")
    case = F.col("event_id") % 4
    texts = (
        F.when(case == 1, F.to_json(F.struct(F.col("value").alias("k"))))
        .when(case == 2, F.to_json(F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("event_type").alias("kind"), F.col("event_type").alias("mixed"))))
        .when(case == 3, F.to_json(F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("user_id").alias("mixed"))))
        .otherwise(F.col("props"))
    )
    given = events.select("event_id", texts.alias("text"))
    schema = conform.infer_json_schema_of_all(given, "text")
    return conform.parse_json(given, schema, "text").select("event_id", "k", "kind", "mixed")


@query(
    "stream_names",
    sql(
        """SELECT "Farm_ID", "Crop_ID", "Soil_Fertility", "Weather_Sunlight", CAST("Planting_Date" AS DATE)
        AS "Planting_Date" FROM raw"""
    ),
)
def stream_names(b: Binding) -> DataFrame:
    """Records under the names they have in the stream, brought under those of the batch."""
    streamed = b.raw.withColumnsRenamed({batch: stream for stream, batch in agri.STREAM_NAMES.items()})
    return star.conformed(streamed).select("Farm_ID", "Crop_ID", "Soil_Fertility", "Weather_Sunlight", "Planting_Date")


@query("preview_rows", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 2")
def preview_rows(b: Binding) -> DataFrame:
    """The first two rows of a table; that there are two is the feature."""
    return quality.preview(b.table("lineitem").select("l_orderkey", "l_linenumber").orderBy("l_orderkey", "l_linenumber"))


# Sinks


@query("seed_reload", sql("SELECT crop_id, crop_name, crop_type, growing_season, water_needs FROM crops"))
def seed_reload(b: Binding) -> DataFrame:
    """A seed loaded twice: the table holds its rows once."""
    csv, table, path = new_path(b.spark, "reload-csv"), table_name("reload"), new_path(b.spark, "reload")
    schema = agri.seed_schema("seed_crop")
    b.crops.select(*schema.names).write.csv(csv, header=True)
    for _ in range(2):
        table_sinks.reload_seed(b.spark, csv, schema, table, path)
    return stored_table(b, table, path)


@query("write_star_fact", SQL["fact_production"])
def write_star_fact(b: Binding) -> DataFrame:
    """The rows of a fact as they were written with the other tables."""
    written = star.write_star(b.stored_raw(), new_path(b.spark, "star"))
    return b.spark.read.parquet(written["fact_farm_production"])


# Quality


@query(
    "dq_repeated",
    """SELECT 'unique' AS check_name, 'o_custkey' AS column_name, 'warn' AS severity, COUNT(*) AS violations
        FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) > 1)
        UNION ALL SELECT 'unique', 'o_orderkey', 'error', COUNT(*)
        FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1)""",
)
def dq_repeated(b: Binding) -> DataFrame:
    """A column whose values do repeat, and one whose values do not."""
    return quality.run_checks(b.table("orders"), [quality.Unique("o_custkey"), quality.Unique("o_orderkey", "error")])


@query(
    "dq_severity",
    sql(
        """SELECT 'not_null(ph_level): ' || COUNT(*) AS line FROM farms f LEFT JOIN soil s ON f.farm_id = s.farm_id
          WHERE ph_level IS NULL HAVING COUNT(*) > 0
        UNION ALL SELECT 'unique(farm_location): ' || COUNT(*) FROM (SELECT farm_location FROM farms
          WHERE farm_location IS NOT NULL GROUP BY farm_location HAVING COUNT(*) > 1) HAVING COUNT(*) > 0
        UNION ALL SELECT 'failed: unique(o_custkey): ' || COUNT(*) FROM (SELECT o_custkey FROM orders
          GROUP BY o_custkey HAVING COUNT(*) > 1) HAVING COUNT(*) > 0"""
    ),
)
def dq_severity(b: Binding) -> DataFrame:
    """Warnings are told of, an error fails: one line per failed check."""
    farms = b.farms.join(b.soil, "farm_id", "left")
    checks = [quality.NotNull("ph_level"), quality.NotNull("farm_id", "error"), quality.Unique("farm_location")]
    lines = quality.enforce(quality.run_checks(farms, checks))
    try:
        quality.enforce(quality.run_checks(b.table("orders"), [quality.Unique("o_custkey", "error")]))
    except quality.CheckFailed as failed:
        lines.append(f"failed: {failed}")
    return file_sources.read_rows(b.spark, [(line,) for line in lines], "line string")


# Marts

GENERATED = datetime(AS_OF_YEAR, 1, 1)


def published_sql(name: str) -> str:
    columns = ", ".join(c for c in agri.MARTS[name] if c != "generated_at")
    return f"SELECT {columns}, TIMESTAMP '{GENERATED}' AS generated_at FROM ({SQL[name]})"


@query("published_seasons", published_sql("seasonal_performance"))
def published_seasons(b: Binding) -> DataFrame:
    """A mart in the order of its contract with its audit time."""
    mart = marts.seasonal_performance(b.records, b.farms, b.crops, b.weather, RECORDS)
    return marts.published(mart, "seasonal_performance", GENERATED)


LITERAL = {
    "avg_soil_moisture": "AVG(soil_moisture)",
    "avg_soil_temperature": "AVG(soil_temperature)",
    "avg_soil_ph": "AVG(ph_level)",
    "avg_organic_matter": "AVG(organic_matter)",
    "avg_water_usage": "AVG(water_usage)",
    "avg_carbon_footprint": "AVG(carbon_footprint)",
    "avg_pesticide_usage": "AVG(pesticide_usage)",
    "avg_yield_per_hectare": "AVG(yield_per_hectare)",
    "avg_actual_yield": "AVG(actual_yield)",
    "avg_expected_yield": "AVG(expected_yield)",
    "total_actual_yield": "SUM(actual_yield)",
    "avg_yield_percentage": "AVG(yield_percentage)",
    "avg_sustainability_score": "AVG(sustainability_score)",
    "recent_avg_yield": f"AVG(CASE WHEN r.year >= {AS_OF_YEAR - 1} THEN actual_yield END)",
    "avg_growing_period": "AVG(growing_period_days)",
    "yield_per_acre": "AVG(actual_yield / NULLIF(farm_size_acres, 0))",
    "farm_performance_score": """AVG(yield_percentage) * 0.4 + AVG(sustainability_score) * 0.3
        + (100 - AVG(COALESCE(water_usage, 0)) * 0.1) + (100 - AVG(COALESCE(carbon_footprint, 0)) * 0.2)""",
}


@query(
    "farm_performance_literal",
    sql(
        f"""SELECT f.farm_id, r.crop_type AS farm_type, f.farm_size AS avg_farm_size_acres,
        {", ".join(f"CAST(CAST({value} AS FLOAT) AS DOUBLE) AS {name}" for name, value in LITERAL.items())}
        FROM farms f LEFT JOIN records r ON f.farm_id = r.farm_id LEFT JOIN soil s ON f.farm_id = s.farm_id
        LEFT JOIN sustainability u ON f.farm_id = u.farm_id LEFT JOIN yields y ON f.farm_id = y.farm_id
        GROUP BY f.farm_id, f.farm_name, f.farm_location, r.crop_type, f.farm_size"""
    ),
)
def farm_performance_literal(b: Binding) -> DataFrame:
    """The measures of the farm mart, to be held against the joins that it does not form.

    In plain double arithmetic, and shown in single precision, as the two sum in different orders.
    """
    mart = marts.farm_performance(b.farms, b.records, b.soil, b.sustainability, b.yields, AS_OF_YEAR)
    measures = [F.col(name).cast("float").cast("double").alias(name) for name in LITERAL]
    return mart.select("farm_id", "farm_type", "avg_farm_size_acres", *measures)


SEASONS, RESOURCES = SQL["seasonal_performance"], SQL["sustainability_metrics"]


def missing(mart: str, column: str, statement: str) -> str:
    return f"""SELECT 'not_null' AS check_name, '{mart}.{column}' AS column_name, 'warn' AS severity,
        COUNT(*) FILTER (WHERE {column} IS NULL) AS violations FROM ({statement})"""


def out_of_range(mart: str, column: str, statement: str) -> str:
    return f"""SELECT 'in_range', '{mart}.{column}', 'warn',
        COUNT(*) FILTER (WHERE NOT {column} BETWEEN 1 AND 5) FROM ({statement})"""


def run_sql() -> str:
    keys = " UNION ALL ".join(
        f"""SELECT 'unique' AS check_name, '{view}.{key}' AS column_name, 'warn' AS severity, COUNT(*) AS violations
        FROM (SELECT {key} FROM {KEYED[view]} WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1)
        UNION ALL SELECT 'not_null', '{view}.{key}', 'warn', COUNT(*) FILTER (WHERE {key} IS NULL) FROM {KEYED[view]}"""
        for view, key in staging.SEED_KEYS.items()
    )
    farm, crop = farm_sql("records"), crop_sql()
    parts = [
        sql(keys),
        missing("farm_performance", "farm_id", farm), missing("farm_performance", "farm_type", farm),
        missing("crop_performance", "crop_type", crop), missing("crop_performance", "crop_name", crop),
        missing("seasonal_performance", "farm_id", SEASONS), missing("seasonal_performance", "crop_id", SEASONS),
        out_of_range("seasonal_performance", "season_performance_rating", SEASONS),
        missing("sustainability_metrics", "farm_id", RESOURCES),
        out_of_range("sustainability_metrics", "sustainability_tier", RESOURCES),
        *[f"SELECT 'rows', '{name}', 'info', COUNT(*) FROM ({SQL[name]})" for name in agri.MARTS],
    ]
    return " UNION ALL ".join(f"SELECT * FROM ({part})" for part in parts)


@query("marts_run", run_sql())
def marts_run(b: Binding) -> DataFrame:
    """A whole run: what every check found, and how many rows each stored mart has."""
    b.shared()
    done = run.run_marts(materialise(b.records, "records"), b.seeds, GENERATED, new_path(b.spark, "marts"), RECORDS)
    counts = [
        b.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("rows").alias("check_name"), F.lit(name).alias("column_name"), F.lit("info").alias("severity"),
            "violations",
        )
        for name, path in done.paths.items()
    ]
    return conform.union_all([done.results, *counts])
