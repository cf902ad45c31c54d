"""Offset-sequence checks that never sort a whole feed partition in one task.

A window over (topic, partition) would send a feed partition holding a third of
all messages to one task. Instead positions are cut into fixed blocks of
``2**BLOCK_BITS``; windows run inside a block. What goes from block to block is one
or two rows per block, and a window over those gives exactly what the single one would.
Copies of a delivery are combined before any of it, so that a message
delivered again and again does not fill its block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notice_lake.schemas import DELIVERY_KEY

BLOCK_BITS = 20

_PARTITION = DELIVERY_KEY[:2]
_POSITION = DELIVERY_KEY[2]


def offset_gaps(messages: DataFrame, *, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Runs of offsets missing between two delivered ones, per topic and partition.

    One scan. In each block only the edges and the offsets before a hole remain; the
    last offset of a block then meets the first of the next one.
    """
    part = list(_PARTITION)
    in_block = Window.partitionBy(*part, "_block").orderBy(_POSITION)
    rows = (
        messages.select(*DELIVERY_KEY).distinct()
        .withColumn("_block", F.shiftright(_POSITION, block_bits))
        .withColumn("_after", F.lead(_POSITION).over(in_block))
        .withColumn("_first", F.lag(_POSITION).over(in_block).isNull())
    )
    rows = rows.filter(F.col("_first") | F.col("_after").isNull() | (F.col("_after") - F.col(_POSITION) > 1))
    # Edges of all blocks follow each other; other offsets stay with their block.
    edge = F.col("_first") | F.col("_after").isNull()
    between = Window.partitionBy(*part, "_group").orderBy(_POSITION)
    rows = rows.withColumn("_group", F.when(~edge, F.col("_block"))).withColumn(
        "_after", F.coalesce("_after", F.lead(_POSITION).over(between))
    )
    return rows.filter(F.col("_after") - F.col(_POSITION) > 1).select(
        *part,
        (F.col(_POSITION) + 1).alias("gap_start"),
        (F.col("_after") - 1).alias("gap_end"),
        (F.col("_after") - F.col(_POSITION) - 1).alias("missing"),
    )


def late_messages(messages: DataFrame, *, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Messages older than some message at a smaller offset of their partition.

    Copies of one delivery are counted, not listed: ``deliveries`` says how often
    that offset arrived with that timestamp. Two scans: one for the newest time of each
    block, one for the rows, which meet the newest time of the blocks before.
    """
    part = list(_PARTITION)
    block = F.shiftright(_POSITION, block_bits)
    newest = messages.groupBy(*part, block.alias("_block")).agg(F.max("kafka_timestamp").alias("_newest"))
    blocks_before = (
        Window.partitionBy(*part).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = newest.select(*part, "_block", F.max("_newest").over(blocks_before).alias("_carried"))
    smaller_offsets = (
        Window.partitionBy(*part, "_block").orderBy(_POSITION).rangeBetween(Window.unboundedPreceding, -1)
    )
    copies = messages.groupBy(*DELIVERY_KEY, "kafka_timestamp").agg(F.count("*").alias("deliveries"))
    return (
        copies.withColumn("_block", block).join(carried, [*part, "_block"])
        .withColumn(
            "latest_before", F.greatest(F.max("kafka_timestamp").over(smaller_offsets), "_carried")
        )
        .filter(F.col("kafka_timestamp") < F.col("latest_before"))
        .select(*DELIVERY_KEY, "kafka_timestamp", "latest_before", "deliveries")
    )
