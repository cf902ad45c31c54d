"""Small hand-made message tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from notice_lake.schemas import BRONZE

START = datetime(2024, 1, 1)


def message_table(spark, texts, partition=0):
    rows = [
        ("k", text, "t", partition, offset, START + timedelta(minutes=offset))
        for offset, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, BRONZE)


def deliveries(spark, rows):
    """Messages from (partition, offset, minute) triples; texts are NULL."""
    return spark.createDataFrame(
        [(None, None, "t", p, o, START + timedelta(minutes=m)) for p, o, m in rows], BRONZE
    )


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def optimized_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
