"""Time the operators that replace a plainer plan against that plan.

    python tools/measure.py [directory]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from martflow.bindings.testdata import Binding  # noqa: E402
from martflow.operators import joins  # noqa: E402
from martflow.operators.ranking import Rank, add_ranks  # noqa: E402
from martflow.session import build_session  # noqa: E402
from martflow.sources.files import read_drifting  # noqa: E402
from martflow.workload.registry import QUERIES  # noqa: E402
from martflow.workload import relational  # noqa: E402, F401
from martflow.workspace import materialise, new_path  # noqa: E402


def timed(label: str, build) -> None:
    best = None
    for _ in range(2):
        started = time.time()
        result: DataFrame = build()
        result.write.format("noop").mode("overwrite").save()
        spent = time.time() - started
        best = spent if best is None else min(best, spent)
    print(f"{label}: {best:.2f} s", flush=True)


def main() -> None:
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "measure", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    b = Binding(spark, directory)

    path = new_path(spark, "drift")
    lines = b.table("lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    for flag, frame in {
        "A": lines.withColumn("amount", F.col("l_quantity").cast("bigint")),
        "N": lines.withColumn("amount", F.col("l_quantity")),
        "R": lines,
    }.items():
        frame.where(F.col("l_returnflag") == flag).repartition(100).write.parquet(f"{path}/{flag}")
    found = sorted(spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                   .option("recursiveFileLookup", True).load(path).inputFiles())

    def per_file() -> DataFrame:
        whole = None
        for file in found:
            frame = spark.read.parquet(file)
            if "amount" in frame.columns:
                frame = frame.withColumn("amount", F.col("amount").cast("double"))
            whole = frame if whole is None else whole.unionByName(frame, allowMissingColumns=True)
        return whole.na.fill(0, ["amount"])

    timed(f"drifting scan, {len(found)} files, one plan node per file", per_file)
    timed(f"drifting scan, {len(found)} files, one scan per schema", lambda: read_drifting(spark, path, ["amount"]))

    numbered = materialise(
        b.table("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice").withColumn(
            "id", F.monotonically_increasing_id()
        )
    )
    order = [F.col("l_extendedprice").desc_nulls_last(), F.col("id")]
    timed("row number of lineitem, window in one task",
          lambda: numbered.withColumn("r", F.row_number().over(Window.orderBy(*order))))
    timed("row number of lineitem, distributed",
          lambda: add_ranks(numbered, [Rank("r", "l_extendedprice", ["id"])], window_rows=0))

    records = b.records.select("farm_id", "crop_id", "actual_yield")
    averages = {"t": F.avg("temperature"), "p": F.avg("precipitation")}
    timed("constant lookup, nested-loop join", lambda: records.join(b.weather, F.lit(True), "left")
          .groupBy("farm_id", "crop_id").agg(F.avg("actual_yield"), *[v.alias(k) for k, v in averages.items()]))
    timed("constant lookup, scalar subquery", lambda: joins.attach_summary(
        records.groupBy("farm_id", "crop_id").agg(F.avg("actual_yield")), b.weather, averages))

    small = Binding(spark, directory.replace("sf0.1", "sf0.01"))
    timed("crops of a type and its records at sf0.01, all pairs", lambda: small.crops.join(small.records.drop("crop_id"), "crop_type", "left")
          .groupBy("crop_id").agg(F.count(F.lit(1)), F.avg("actual_yield"), F.count_distinct("farm_id")))
    timed("crops of a type and its records at sf0.01, condensed", lambda: QUERIES["join_many_to_many"](spark, small.directory))
    timed("crops of a type and its records, condensed", lambda: QUERIES["join_many_to_many"](spark, directory))
    spark.stop()


if __name__ == "__main__":
    main()
