"""Reports kept up to date by a stream, from mergeable partial aggregates.

Each micro-batch aggregates its own rows only and writes the partial result as a segment of level 0. Segments are merged
by levels as in ``segments``, so a report over n batches reads a number of folders that grows with log n and rows that grow
with its groups, never the messages. Partial results combine by sum, min and max: they may be merged in any order,
and a repeated batch replaces its own segment.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_lake.streaming import segments


@dataclass(frozen=True)
class Report:
    """``table``: the batch output it is made from. ``keys``: names of the groups and their SQL.

    ``parts``: names of the partial aggregates, each with its SQL and the function (sum, min, max) that merges it.
    ``finish``: the report from merged partial aggregates. ``where``: SQL of the rows that count.
    """

    table: str
    keys: dict[str, str]
    parts: dict[str, tuple[str, str]]
    finish: Callable[[DataFrame], DataFrame] = field(default=lambda merged: merged)
    where: str = "true"


def _accuracy(merged: DataFrame) -> DataFrame:
    return merged.select(
        "loc_algorithm",
        "notices",
        F.round(F.col("error_sum") / F.col("notices"), 4).alias("avg_error_deg"),
        "min_error_deg",
        "max_error_deg",
    ).orderBy(F.desc("notices"), F.col("loc_algorithm").asc_nulls_last())


def _count_if(condition: str) -> tuple[str, str]:
    return f"count_if({condition})", "sum"


ROWS = ("count(*)", "sum")

REPORTS: dict[str, Report] = {
    "accuracy_by_algorithm": Report(
        "fact_notices",
        {"loc_algorithm": "loc_algorithm"},
        {
            "notices": ROWS,
            "error_sum": ("sum(grb_error_deg)", "sum"),
            "min_error_deg": ("min(grb_error_deg)", "min"),
            "max_error_deg": ("max(grb_error_deg)", "max"),
        },
        _accuracy,
        where="grb_error_deg IS NOT NULL",
    ),
    "activity_by_partition": Report(
        "fact_notices",
        {"kafka_partition": "kafka_partition"},
        {
            "notices": ROWS,
            "first_offset": ("min(kafka_offset)", "min"),
            "latest_offset": ("max(kafka_offset)", "max"),
            "latest_event": ("max(kafka_timestamp)", "max"),
        },
        lambda merged: merged.orderBy("kafka_partition"),
    ),
    "latest_by_partition": Report(
        "bronze",
        {"kafka_partition": "kafka_partition"},
        {
            "latest_offset": ("max(kafka_offset)", "max"),
            "latest_timestamp": ("max(kafka_timestamp)", "max"),
        },
    ),
    "parse_quality": Report(
        "silver",
        {},
        {
            "total_notices": ROWS,
            "missing_trigger": _count_if("TRIGGER_NUM IS NULL"),
            "missing_position": _count_if("GRB_RA IS NULL OR GRB_DEC IS NULL"),
            "missing_notice_date": _count_if("NOTICE_DATE IS NULL"),
        },
    ),
}
REPORTS |= {
    f"rows_of_{table}": Report(table, {"layer": f"'{table}'"}, {"row_count": ROWS})
    for table in ("bronze", "silver", "fact_notices")
}


def partial(rows: DataFrame, report: Report) -> DataFrame:
    """The aggregates of some rows. Combined per group before the shuffle, so a hot group fills no task."""
    keys = [F.expr(sql).alias(name) for name, sql in report.keys.items()]
    parts = [F.expr(sql).alias(name) for name, (sql, _) in report.parts.items()]
    return rows.filter(report.where).groupBy(*keys).agg(*parts)


def merged(partials: DataFrame, report: Report) -> DataFrame:
    """Partial aggregates of parts of the rows, as those of all rows."""
    parts = [F.expr(f"{merge}({name})").alias(name) for name, (_, merge) in report.parts.items()]
    return partials.groupBy(*report.keys).agg(*parts)


def add(rows: DataFrame, folder: str, report: Report, batch: int) -> None:
    """Add the rows of a batch to the report in ``folder``. Repeating a batch replaces its part."""
    spark = rows.sparkSession
    segments.write(partial(rows, report), folder, batch)
    for level, first, parts in segments.completed(batch):
        whole = merged(_read(spark, folder, parts), report)
        whole.write.mode("overwrite").parquet(segments.place(folder, level, first))


def read(spark: SparkSession, folder: str, report: Report, batches: int) -> DataFrame:
    """The merged partial aggregates of the first ``batches`` batches, of which there must be one."""
    return merged(_read(spark, folder, segments.covering(batches)), report)


def _read(spark: SparkSession, folder: str, parts: list[tuple[int, int]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [spark.read.parquet(segments.place(folder, *part)) for part in parts])
