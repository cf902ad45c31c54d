"""Orphans of a running feed: rows whose dimension row does not arrive in time.

Child rows and dimension rows are two streams, joined on the key within a span of event time, with a watermark on both
sides. A child row waits in the state until a dimension row of its key arrives or the watermark has passed the span;
only then it counts as unmatched. State is bounded by the span: dimension rows older than it are not remembered, so the few
unmatched rows of a batch meet the stored dimension once before they are called orphans. Orphans are kept as mergeable partial
aggregates per key (``maintained``): a restart or a repeated batch counts each row once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from notice_lake.schemas import DELIVERY_KEY
from notice_lake.streaming import fan_out, maintained
from notice_lake.streaming.hops import AVAILABLE_NOW, Trigger, for_each_batch, rocksdb_state

Known = Callable[[SparkSession], DataFrame]

_TABLE = "orphans"
REPORT = maintained.Report(
    _TABLE,
    {"key_value": "_child_key"},
    {
        "child_rows": maintained.ROWS,
        "first_timestamp": ("min(kafka_timestamp)", "min"),
        "latest_timestamp": ("max(kafka_timestamp)", "max"),
    },
)


def _instant(df: DataFrame) -> Column:
    """The feed's clock as an instant: watermarks need one. A clock without zone is read as UTC in any session."""
    if isinstance(df.schema["kafka_timestamp"].dataType, T.TimestampNTZType):
        return F.expr("TIMESTAMP_LTZ'1970-01-01 00:00:00Z' + (kafka_timestamp - TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return F.col("kafka_timestamp")


def unmatched(
    children: DataFrame,
    parents: DataFrame,
    column: str,
    parent_column: str,
    *,
    delay: str = "10 MINUTES",
    wait: str = "1 HOUR",
    back: str = "1 HOUR",
    salts: int = 8,
) -> DataFrame:
    """Child rows for which no parent row is seen from ``back`` before them to ``wait`` after them.

    ``delay`` is how late rows of either stream may be. Both streams have ``kafka_timestamp``; children have the delivery
    key, by which the rows of a hot key spread over ``salts`` state partitions, and parents one row per key, which goes to
    each of them. Rows with a NULL key refer to nothing and are not orphans; rows without a timestamp
    cannot be placed and are left to ``checks.orphan_keys``.
    """
    own = (
        children.filter(F.col(column).isNotNull())
        .select(
            *DELIVERY_KEY,
            "kafka_timestamp",
            F.col(column).alias("_child_key"),
            _instant(children).alias("_time"),
            F.pmod(F.xxhash64(*DELIVERY_KEY), F.lit(salts)).alias("_child_salt"),
        )
        .filter(F.col("_time").isNotNull())
        .withWatermark("_time", delay)
    )
    seen = (
        parents.filter(F.col(parent_column).isNotNull())
        .select(F.col(parent_column).alias("_parent_key"), _instant(parents).alias("_seen"))
        .withWatermark("_seen", delay)
        .withColumn("_parent_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    )
    met = F.expr(
        "_child_key = _parent_key AND _child_salt = _parent_salt"
        f" AND _seen >= _time - INTERVAL {back} AND _seen <= _time + INTERVAL {wait}"
    )
    rows = own.join(seen, met, "left").filter(F.col("_parent_key").isNull())
    return rows.select(*DELIVERY_KEY, "kafka_timestamp", "_child_key")


def write_batch(rows: DataFrame, batch_id: int, *, folder: str, known: Known | None) -> None:
    """Adds the unmatched rows of one micro-batch that the stored dimension does not know either."""
    if known is not None:
        rows = rows.join(known(rows.sparkSession).toDF("_child_key"), "_child_key", "left_anti")
    maintained.add(rows, f"{folder}/{_TABLE}", REPORT, batch_id)
    fan_out.commit(rows.sparkSession, folder, batch_id)


def start_orphans(
    children: DataFrame,
    parents: DataFrame,
    column: str,
    parent_column: str,
    folder: str,
    checkpoint: str,
    *,
    known: Known | None = None,
    delay: str = "10 MINUTES",
    wait: str = "1 HOUR",
    back: str = "1 HOUR",
    salts: int = 8,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Count orphans of ``column`` per key. ``known`` reads the stored keys of the dimension as one column."""
    rows = unmatched(children, parents, column, parent_column, delay=delay, wait=wait, back=back, salts=salts)
    with rocksdb_state(children.sparkSession):
        return for_each_batch(rows, partial(write_batch, folder=folder, known=known), checkpoint, trigger=trigger)


def read_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Orphan keys so far: how many child rows hold each, the first and the latest of them."""
    done = fan_out.last_batch(spark, folder)
    if done < 0:
        raise ValueError(f"no batch of {folder} is done")
    return maintained.read(spark, f"{folder}/{_TABLE}", REPORT, done + 1)
