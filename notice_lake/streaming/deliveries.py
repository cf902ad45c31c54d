"""A stream that takes each delivery once, and knows its holes.

Each micro-batch drops what the index of delivered intervals holds, appends the rest, and writes the index
with its own intervals merged in. Batch N reads the index of batch N - 1 and writes its own folders with overwrite, so a
retried batch, a restart, deliveries out of order and a feed delivered again from the start all give the same table.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from notice_lake.operators import intervals
from notice_lake.sources import files
from notice_lake.sources.scratch import stored
from notice_lake.streaming import fan_out
from notice_lake.streaming.hops import AVAILABLE_NOW, Trigger, for_each_batch

_MESSAGES, _INDEX = "messages", "delivered"


def _index_of(spark: SparkSession, folder: str, batch_id: int, clock: T.DataType) -> DataFrame:
    schema = intervals.index_schema(clock)
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(fan_out.batch_folder(folder, _INDEX, batch_id))


def write_batch(messages: DataFrame, batch_id: int, *, folder: str) -> None:
    """The new messages of one micro-batch, and the index after it. Safe to repeat with the same batch id."""
    spark = messages.sparkSession
    # The batch is read several times; its source is read once.
    batch = stored(messages, "deliveries")
    before = _index_of(spark, folder, batch_id - 1, messages.schema["kafka_timestamp"].dataType)
    fresh = intervals.undelivered(batch, before)
    fresh.write.mode("overwrite").parquet(fan_out.batch_folder(folder, _MESSAGES, batch_id))
    after = intervals.merged(before.unionByName(intervals.delivered(batch)))
    after.select(*before.columns).write.mode("overwrite").parquet(fan_out.batch_folder(folder, _INDEX, batch_id))
    fan_out.commit(spark, folder, batch_id)
    # A retry of this batch needs the index before it, nobody needs older ones.
    files.remove(spark, fan_out.batch_folder(folder, _INDEX, batch_id - 2))


def start_deliveries(messages: DataFrame, folder: str, checkpoint: str, *, trigger: Trigger = AVAILABLE_NOW) -> StreamingQuery:
    """Run ``write_batch`` over a bronze stream. A new checkpoint needs an empty folder."""
    return for_each_batch(messages, partial(write_batch, folder=folder), checkpoint, trigger=trigger)


def read_messages(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Each delivery once, from batches that are done."""
    done = fan_out.last_batch(spark, folder)
    if done < 0:
        return spark.createDataFrame([], schema)
    typed = T.StructType([*schema, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(typed).parquet(f"{folder}/{_MESSAGES}").filter(F.col("batch_id") <= done).drop("batch_id")


def read_index(spark: SparkSession, folder: str, clock: T.DataType) -> DataFrame:
    """The intervals delivered by all batches that are done."""
    return _index_of(spark, folder, fan_out.last_batch(spark, folder), clock)
