"""The layers as a declarative graph for ``spark-pipelines``.

Needs a pipeline run around it: the decorators raise elsewhere, so nothing in
this package imports the module. Its test puts plain decorators in their place.
Define in the pipeline's source file::

    from notice_lake.streaming.declarative import define
    define(spark, kafka_options(...))
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from notice_lake.operators.layers import DIMENSIONS, bronze, fact, silver, stream_dimension
from notice_lake.schemas import GOLD
from notice_lake.sources.kafka import read_topic
from notice_lake.sources.tables import TABLES, conform


def define(spark: SparkSession, kafka: Mapping[str, str], *, catalog: str | None = None) -> None:
    from pyspark import pipelines as sdp

    def named(table: str) -> str:
        return f"{catalog}.{table}" if catalog else table

    raw, parsed = "bronze.notices_raw", "silver.notices"

    @sdp.table(name=named(raw), comment=TABLES[raw])
    def notices_raw():
        return bronze(read_topic(spark, kafka))

    @sdp.table(name=named(parsed), comment=TABLES[parsed])
    def notices():
        return silver(spark.readStream.table(named(raw)))

    @sdp.table(
        name=named("gold.fact_notices"),
        comment=TABLES["gold.fact_notices"],
        schema=GOLD["fact_notices"].schema,
    )
    def fact_notices():
        rows = fact(spark.readStream.table(named(parsed)))
        return conform(rows, GOLD["fact_notices"].schema)

    def define_dimension(table: str) -> None:
        @sdp.table(
            name=named(f"gold.{table}"),
            comment=TABLES[f"gold.{table}"],
            schema=GOLD[table].schema,
        )
        def rows():
            stream = spark.readStream.table(named(parsed))
            return conform(stream_dimension(stream, table), GOLD[table].schema)

    for table in DIMENSIONS:
        define_dimension(table)
