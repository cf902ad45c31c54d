"""One streaming query per hop: read a layer, transform, append to the next.

Restarting with the same checkpoint resumes; a new checkpoint with an empty
target reprocesses from the start. Both triggers below are micro-batch.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from notice_lake.operators.layers import stream_dimension
from notice_lake.sources.scratch import new_folder
from notice_lake.sources.tables import conform

Trigger = dict[str, str | bool]

# Work off what is there, in as many micro-batches as the source limits ask for.
AVAILABLE_NOW: Trigger = {"availableNow": True}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def every(interval: str) -> Trigger:
    """Keep running, one micro-batch per interval, e.g. ``every("10 seconds")``."""
    return {"processingTime": interval}


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own setting comes back.

    A query takes its settings along when it starts.
    """
    option = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(option, None)
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        spark.conf.unset(option) if before is None else spark.conf.set(option, before)


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state on executor disk: first-seen keys are never forgotten."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def append_to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    trigger: Trigger = AVAILABLE_NOW,
    fmt: str = "parquet",
) -> StreamingQuery:
    """``schema`` is the contract of the table that the files are; rows that break it stop the query."""
    return (
        _conformed(df, schema).writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def append_to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    *,
    schema: T.StructType | None = None,
    trigger: Trigger = AVAILABLE_NOW,
    fmt: str = "parquet",
) -> StreamingQuery:
    return (
        _conformed(df, schema).writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .toTable(table)
    )


def _conformed(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    return df if schema is None else conform(df, schema)


def start_dimension(
    notices: DataFrame,
    table: str,
    path: str,
    checkpoint: str,
    *,
    algo: str = "hash",
    columns: tuple[str, ...] = ("*",),
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append each key of a dimension once, as it first arrives; its state lives in RocksDB.

    The key and its key attributes do not depend on the order of arrival. Other attributes are
    those of whichever notice of the key arrived first.
    """
    rows = stream_dimension(notices, table, algo=algo).select(*columns)
    with rocksdb_state(notices.sparkSession):
        return append_to_files(rows, path, checkpoint, trigger=trigger)


def inspect(df: DataFrame) -> DataFrame:
    """What a stream has to offer now, written to the shared folder, to look at as a table."""
    folder = new_folder(df.sparkSession, "inspect")
    append_to_files(df, f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")


def for_each_batch(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
