"""A stream that stops when too large a share of its rows breaks an expectation.

Each micro-batch is checked and written in one pass: breaches are observed while the rows are written. The
share is taken over the last batches, this one included, so one bad row in a small batch stops nothing and a slow decline
does. A batch that crosses a limit is written but not marked as done, and the query fails: readers never see it. A restart
repeats that batch and fails again, until the limit is raised, the batch is accepted by hand (``accept``) or the parser changes.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from notice_lake.operators.quality import Predicate, expect
from notice_lake.sources import files
from notice_lake.streaming import fan_out
from notice_lake.streaming.hops import AVAILABLE_NOW, Trigger, for_each_batch

_ROWS, _COUNTS, _ACCEPTED = "rows", "breaches", "accepted"
_SCHEMA = "expectation string, row_count long, failed long"


@dataclass(frozen=True)
class Limits:
    """``shares``: per expectation, the largest share of breaking rows that goes on; others only warn.

    ``batches``: how many batches, the newest included, a share is taken over. ``min_rows``: below so many rows in
    them nothing is judged.
    """

    shares: Mapping[str, float]
    batches: int = 10
    min_rows: int = 1


class TooManyBreaches(RuntimeError):
    """A share crossed its limit."""


def write_batch(
    rows: DataFrame,
    batch_id: int,
    *,
    folder: str,
    expectations: Mapping[str, Predicate],
    limits: Limits,
    action: str = "warn",
) -> None:
    """The rows of one micro-batch and its counts; done only if all shares hold. Safe to repeat with the same batch id."""
    spark = rows.sparkSession
    # Narrow from source to file: a retried task replaces its counts.
    counted = Observation()
    checked = expect(rows, expectations, action=action, observe=counted)
    checked.write.mode("overwrite").parquet(fan_out.batch_folder(folder, _ROWS, batch_id))
    found = counted.get
    counts = [(name, found["rows"], found[name]) for name in expectations]
    spark.createDataFrame(counts, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        fan_out.batch_folder(folder, _COUNTS, batch_id)
    )
    if str(batch_id) not in files.names(spark, f"{folder}/{_ACCEPTED}"):
        _judge(spark, folder, batch_id, limits)
    fan_out.commit(spark, folder, batch_id)


def _judge(spark: SparkSession, folder: str, batch_id: int, limits: Limits) -> None:
    first = max(0, batch_id - limits.batches + 1)
    # One row per expectation.
    over = [
        f"{r.expectation}: {r.failed} of {r.row_count} rows, limit {limits.shares[r.expectation]}"
        for r in _shares(_counts(spark, folder, range(first, batch_id + 1))).collect()
        if r.expectation in limits.shares
        and r.row_count >= max(limits.min_rows, 1)
        and r.failed > limits.shares[r.expectation] * r.row_count
    ]
    if over:
        raise TooManyBreaches(f"batch {batch_id}: " + "; ".join(sorted(over)))


def _counts(spark: SparkSession, folder: str, batches: range) -> DataFrame:
    schema = T.StructType.fromDDL(_SCHEMA)
    parts = [
        spark.read.schema(schema).parquet(fan_out.batch_folder(folder, _COUNTS, k)).withColumn("batch_id", F.lit(k).cast("long"))
        for k in batches
    ]
    return reduce(DataFrame.unionByName, parts)


def _shares(counts: DataFrame) -> DataFrame:
    return counts.groupBy("expectation").agg(F.sum("row_count").alias("row_count"), F.sum("failed").alias("failed"))


def start_guarded(
    rows: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    expectations: Mapping[str, Predicate],
    limits: Limits,
    action: str = "warn",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Run ``write_batch`` over a stream. ``action`` (warn, drop, fail) is what happens to single rows.

    Limits may change from start to start. A new checkpoint needs an empty folder.
    """
    unknown = set(limits.shares) - set(expectations)
    if unknown:
        raise ValueError(f"no such expectation: {', '.join(sorted(unknown))}")
    write = partial(write_batch, folder=folder, expectations=dict(expectations), limits=limits, action=action)
    return for_each_batch(rows, write, checkpoint, trigger=trigger)


def accept(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Let a batch pass whatever its shares; it still counts in those of later batches."""
    files.mark(spark, f"{folder}/{_ACCEPTED}/{batch_id}")


def read_rows(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches that are done."""
    done = fan_out.last_batch(spark, folder)
    if done < 0:
        return spark.createDataFrame([], schema)
    typed = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(typed).parquet(f"{folder}/{_ROWS}").filter(F.col("batch_id") <= done).drop("batch_id")


def read_breaches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and breaches per batch and expectation, those of a batch that was stopped included."""
    typed = T.StructType([*T.StructType.fromDDL(_SCHEMA), T.StructField("batch_id", T.LongType())])
    share: Column = F.round(F.col("failed") / F.nullif(F.col("row_count"), F.lit(0)), 6)
    counts = spark.read.schema(typed).parquet(f"{folder}/{_COUNTS}")
    done = F.col("batch_id") <= fan_out.last_batch(spark, folder)
    return counts.select("batch_id", "expectation", "row_count", "failed", share.alias("share"), done.alias("done"))
