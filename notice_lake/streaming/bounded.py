"""A dimension fed by a stream whose state forgets.

A key is remembered in the state store for a while after it arrived, counted on the clock of arrival, so no row is ever too
late and dropped. What passes that dedup meets the keys stored so far, so a key that comes back after it was forgotten
is recognised there. State holds the keys of a stretch of time, stored rows hold all.

The clock of the driver must not fall back by more than that stretch between two batches.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from notice_lake.operators.first_seen import first_seen
from notice_lake.operators.layers import DIMENSIONS
from notice_lake.schemas import ARRIVAL_ORDER, DELIVERY_KEY
from notice_lake.streaming import fan_out
from notice_lake.streaming.hops import AVAILABLE_NOW, Trigger, for_each_batch, rocksdb_state


def bounded_rows(notices: DataFrame, table: str, *, algo: str = "hash", remember: str = "1 hour") -> DataFrame:
    """Dimension rows of a stream, a key again only if it was forgotten; with the delivery columns.

    A key passes once per salt, of which there are as many as shuffle partitions: so a hot key fills no task.
    """
    rows, key = DIMENSIONS[table]
    salts = int(notices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows(notices, algo=algo, carry=ARRIVAL_ORDER)
    return (
        keyed.withColumns({"_salt": F.pmod(F.xxhash64(*DELIVERY_KEY), F.lit(salts)), "_arrival": F.current_timestamp()})
        .withWatermark("_arrival", remember)
        .dropDuplicatesWithinWatermark([key, "_salt"])
        .drop("_salt", "_arrival")
    )


def write_batch(rows: DataFrame, batch_id: int, *, folder: str, table: str, algo: str) -> None:
    """The keys of one micro-batch that no earlier one wrote, first arrival first. Safe to repeat with the same batch id."""
    first = first_seen(rows, DIMENSIONS[table][1], ARRIVAL_ORDER)
    fan_out.add_new_rows(first, folder, table, batch_id, algo=algo)
    fan_out.commit(rows.sparkSession, folder, batch_id)


def start_bounded_dimension(
    notices: DataFrame,
    table: str,
    folder: str,
    checkpoint: str,
    *,
    algo: str = "hash",
    remember: str = "1 hour",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append each key of a dimension once; ``read_dimension`` reads it. A new checkpoint needs an empty folder.

    Within a batch the first notice in arrival order wins; across batches the earlier batch wins. ``remember`` sets only what
    state costs and saves: the longer, the fewer rows meet the stored keys.
    """
    rows = bounded_rows(notices, table, algo=algo, remember=remember)
    write = partial(write_batch, folder=folder, table=table, algo=algo)
    with rocksdb_state(notices.sparkSession):
        return for_each_batch(rows, write, checkpoint, trigger=trigger)


def read_dimension(spark: SparkSession, folder: str, table: str, *, algo: str = "hash") -> DataFrame:
    return fan_out.read_output(spark, folder, table, algo=algo)
