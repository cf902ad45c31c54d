"""Colliding surrogate keys of a running feed, found without going back to earlier messages.

A key collides when it stands for two natural keys. Per surrogate key a batch keeps the smallest and the greatest digest
of the natural keys it saw, a sketch of two values that merges by min and max in any order. They differ as soon
as two natural keys share the surrogate key, in whichever batches these came. Only keys whose digests differ are looked up
in the notices, exactly, for the natural keys themselves. Segments of ``maintained`` hold a row per key, never one per message.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from notice_lake.functions.keys import surrogate_key
from notice_lake.operators.checks import key_reuse
from notice_lake.streaming import fan_out, maintained
from notice_lake.streaming.hops import AVAILABLE_NOW, Trigger, for_each_batch

_TABLE = "collisions"


def report(key: str) -> maintained.Report:
    """``_digest`` is SHA-256 of the natural key with NULLs told apart."""
    return maintained.Report(
        _TABLE,
        {key: f"`{key}`"},
        {"row_count": maintained.ROWS, "lowest": ("min(_digest)", "min"), "greatest": ("max(_digest)", "max")},
    )


def write_batch(notices: DataFrame, batch_id: int, *, folder: str, key: str, natural: tuple[str, ...]) -> None:
    """The digests of one micro-batch. Safe to repeat with the same batch id."""
    rows = notices.select(key, surrogate_key(*natural, algo="sha256").alias("_digest"))
    maintained.add(rows, f"{folder}/{_TABLE}", report(key), batch_id)
    fan_out.commit(notices.sparkSession, folder, batch_id)


def start_collisions(
    notices: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    key: str,
    natural: Sequence[str],
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Keep digests of the natural key behind each ``key`` of a silver stream. A new checkpoint needs an empty folder."""
    write = partial(write_batch, folder=folder, key=key, natural=tuple(natural))
    return for_each_batch(notices, write, checkpoint, trigger=trigger)


def read_suspects(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Keys that stand for two natural keys or more, with the number of notices of each."""
    done = fan_out.last_batch(spark, folder)
    if done < 0:
        raise ValueError(f"no batch of {folder} is done")
    counts = maintained.read(spark, f"{folder}/{_TABLE}", report(key), done + 1)
    return counts.filter(F.col("lowest") != F.col("greatest")).select(key, "row_count")


def read_collisions(spark: SparkSession, folder: str, notices: DataFrame, *, key: str, natural: Sequence[str]) -> DataFrame:
    """Colliding keys with the exact number of natural keys and of notices.

    ``notices`` holds the messages read so far; those of other keys leave it before anything is shuffled by natural key.
    """
    suspects = read_suspects(spark, folder, key).select(F.col(key).alias("_suspect"))
    some = notices.join(suspects, F.col(key).eqNullSafe(F.col("_suspect")), "left_semi")
    return key_reuse(some, key, list(natural))
