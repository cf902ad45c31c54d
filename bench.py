"""Headline queries on one table folder; prints one JSON line.

The test table is one file of one row group, which one core reads. Its rows are first
dealt over a file per core, outside of the timed part, as a table of size would be laid out.
Each query runs once to warm up and then RUNS times into a ``noop`` sink, so all
columns of all rows are computed and none are collected. The value is the sum of
the medians. ``extra`` compares the alternatives behind design choices when the
script is called with ``--extra``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notice_lake.operators.layers import DIMENSIONS, dimension, fact, silver
from notice_lake.plans import reports
from notice_lake.registry.queries import QUERIES
from notice_lake.schemas import ARRIVAL_ORDER
from notice_lake.sources import scratch, synthetic

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

# One query per kind of work: parse, cast, first-seen, reports, joins, checks, stream.
HEADLINE = (
    "silver_notices",
    "fact_notices",
    "dim_timing",
    "dim_spatial",
    "accuracy_by_algorithm",
    "parse_quality",
    "fact_with_timing",
    "recent_bursts",
    "burst_sun_moon_context",
    "parse_null_pct",
    "offset_gaps",
    "late_messages",
    "fk_orphans",
    "quarantine",
    "typed_notices",
    "stream_silver",
    "stream_fanout",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", CPUS)
        # The small files of the input, one to a core.
        .config("spark.sql.files.minPartitionNum", CPUS)
        .config("spark.sql.files.openCostInBytes", "64k")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(action, runs: int = RUNS) -> float:
    action()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def laid_out(spark: SparkSession) -> str:
    """A folder with the rows of ``events`` in a file per core."""
    folder = scratch.new_folder(spark, "bench-input")
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet")
    rows.repartition(int(CPUS)).write.parquet(f"{folder}/events.parquet")
    return folder


def headline(spark: SparkSession) -> dict[str, float]:
    folder = laid_out(spark)
    return {
        name: median_seconds(lambda: consume(QUERIES[name](spark, folder))) for name in HEADLINE
    }


def alternatives(spark: SparkSession) -> dict[str, float]:
    """Design choices side by side, over stored layers as a deployment has them."""
    folder = tempfile.mkdtemp(prefix="bench-")

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    bronze = store(synthetic.notices(spark, laid_out(spark)), "bronze")
    parsed = store(silver(bronze), "silver")
    facts = store(fact(parsed), "fact")
    dims = {name: store(dimension(parsed, name), name) for name in DIMENSIONS}

    rows, key = DIMENSIONS["dim_event_timing"]
    ordered = Window.partitionBy(key).orderBy(*ARRIVAL_ORDER)

    def by_row_number() -> DataFrame:
        ranked = rows(parsed, carry=ARRIVAL_ORDER).withColumn("_n", F.row_number().over(ordered))
        return ranked.filter("_n = 1").drop("_n", *ARRIVAL_ORDER)

    def context() -> DataFrame:
        return reports.burst_sun_moon_context(
            facts, dims["dim_spatial_coords"], dims["dim_sun_moon_coords"]
        )

    def without_broadcast(make):
        def action():
            threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            try:
                consume(make())
            finally:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)

        return action

    def four_tables(source: DataFrame) -> None:
        consume(fact(source))
        for name in DIMENSIONS:
            consume(dimension(source, name))

    return {
        "parse: segments": median_seconds(lambda: consume(silver(bronze))),
        "first seen: min_by": median_seconds(lambda: consume(dimension(parsed, "dim_event_timing"))),
        "first seen: row_number": median_seconds(lambda: consume(by_row_number())),
        "first seen: dropDuplicates (not deterministic)": median_seconds(
            lambda: consume(rows(parsed).dropDuplicates([key]))
        ),
        "gold: four scans of stored silver": median_seconds(lambda: four_tables(parsed)),
        "gold: four parses of bronze": median_seconds(lambda: four_tables(silver(bronze))),
        "accuracy over stored fact": median_seconds(
            lambda: consume(reports.accuracy_by_algorithm(facts))
        ),
        "context join over stored gold: broadcast": median_seconds(lambda: consume(context())),
        "context join over stored gold: sort-merge": median_seconds(without_broadcast(context)),
    }


def main() -> None:
    spark = session()
    queries = headline(spark)
    line = {
        "metric": "sum of median query seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }
    if "--extra" in sys.argv[1:]:
        line["extra"] = alternatives(spark)
    scratch.release(spark)
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
