"""Delivered offsets as intervals, per topic and partition.

An interval stands for all offsets from ``first`` to ``last``. ``opened`` is the time of the message at
``first``, ``newest`` the latest time inside. Intervals of parts of a feed merge into those of the whole, in any order and
however often a part comes, so a table of them is an index whose size grows with holes, not with messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notice_lake.operators.sequences import BLOCK_BITS
from notice_lake.schemas import DELIVERY_KEY

_PARTITION = DELIVERY_KEY[:2]
_POSITION = DELIVERY_KEY[2]


def index_schema(clock: T.DataType) -> T.StructType:
    """Columns of an interval; ``clock`` is the type of the messages' time."""
    kinds = (T.StringType(), T.IntegerType(), T.LongType(), T.LongType(), clock, clock)
    names = (*_PARTITION, "first", "last", "opened", "newest")
    return T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])


def merged(intervals: DataFrame) -> DataFrame:
    """Intervals that overlap or touch as one. Where one offset has several times, the earliest opens."""
    in_order = Window.partitionBy(*_PARTITION).orderBy("first", "last", "opened", "newest")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    starts = intervals.withColumn("_reach", F.max("last").over(before))
    starts = starts.withColumn("_new", F.when(F.col("first") <= F.col("_reach") + 1, 0).otherwise(1))
    islands = starts.withColumn("_island", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*_PARTITION, "_island").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.min_by("opened", F.struct("first", "opened")).alias("opened"),
        F.max("newest").alias("newest"),
    ).drop("_island")


def delivered(messages: DataFrame, *, block_bits: int = BLOCK_BITS) -> DataFrame:
    """The intervals of messages in any order, copies included.

    Copies of a delivery are combined first. Runs are found in blocks of offsets, then the runs of all blocks are
    merged; a message without an offset is in no interval.
    """
    each = messages.where(F.col(_POSITION).isNotNull()).groupBy(*DELIVERY_KEY).agg(
        F.min("kafka_timestamp").alias("opened"), F.max("kafka_timestamp").alias("newest")
    )
    in_block = Window.partitionBy(*_PARTITION, "_block").orderBy(_POSITION)
    rows = each.withColumn("_block", F.shiftright(_POSITION, block_bits))
    follows = F.col(_POSITION) - F.lag(_POSITION).over(in_block) == 1
    rows = rows.withColumn("_new", F.when(follows, 0).otherwise(1))
    rows = rows.withColumn("_run", F.sum("_new").over(in_block))
    runs = rows.groupBy(*_PARTITION, "_block", "_run").agg(
        F.min(_POSITION).alias("first"),
        F.max(_POSITION).alias("last"),
        F.min_by("opened", _POSITION).alias("opened"),
        F.max("newest").alias("newest"),
    )
    return merged(runs.drop("_block", "_run"))


def holes(index: DataFrame, patience: str) -> DataFrame:
    """Offsets missing between two delivered ones: ``gap_start``, ``gap_end``, ``missing``, ``opened``, ``lost``.

    A hole opens at the time of the message after it. It is lost once its partition has messages newer than that by more
    than ``patience``, an interval such as ``1 hour``; a delivery that comes later still closes it.
    """
    following = Window.partitionBy(*_PARTITION).orderBy("first")
    whole = Window.partitionBy(*_PARTITION)
    after, opened = F.lead("first").over(following), F.lead("opened").over(following)
    rows = index.withColumns({"_after": after, "_opened": opened, "_newest": F.max("newest").over(whole)})
    return rows.where("_after IS NOT NULL").select(
        *_PARTITION,
        (F.col("last") + 1).alias("gap_start"),
        (F.col("_after") - 1).alias("gap_end"),
        (F.col("_after") - F.col("last") - 1).alias("missing"),
        F.col("_opened").alias("opened"),
        (F.col("_opened") + F.expr(f"INTERVAL {patience}") < F.col("_newest")).alias("lost"),
    )


#: The partition as columns without NULL, so that a group by them and a join on them go by one shuffle.
_PLACE = tuple(f"{mark}{c}" for c in _PARTITION for mark in ("_", "_no_"))


def _placed(rows: DataFrame) -> DataFrame:
    topic, partition = _PARTITION
    values = {f"_{topic}": F.coalesce(topic, F.lit("")), f"_{partition}": F.coalesce(partition, F.lit(0))}
    return rows.withColumns(values | {f"_no_{c}": F.col(c).isNull() for c in _PARTITION})


def undelivered(messages: DataFrame, index: DataFrame, *, block_bits: int = BLOCK_BITS) -> DataFrame:
    """Messages whose offset is in no interval of the index, each once.

    Of several copies the earliest is taken, then the one with the least key and value; they are combined before any shuffle. The index is cut
    to the offsets of the messages, and to blocks. In a block a running maximum over starts of intervals and messages says
    up to where offsets are delivered, so a message meets no interval but the last one before it, however many there are.
    Blocks take the keys of messages only. Texts are shuffled once, by key, and the keys found come to them.
    Messages without an offset cannot be recognised; all of them are returned.
    """
    others = [c for c in messages.columns if c not in DELIVERY_KEY]
    first = F.min(F.struct("kafka_timestamp", *[c for c in others if c != "kafka_timestamp"]))
    known = messages.where(F.col(_POSITION).isNotNull())
    once = _placed(known).groupBy(*_PLACE, _POSITION).agg(first.alias("_first"))
    span = known.groupBy(*_PARTITION).agg(F.min(_POSITION).alias("_low"), F.max(_POSITION).alias("_high"))
    same = [index[c].eqNullSafe(span[c]) for c in _PARTITION]
    cut = index.join(span, same).where("last >= _low AND first <= _high").select(
        *[index[c] for c in _PARTITION], F.greatest("first", "_low").alias("first"), F.least("last", "_high").alias("last")
    )
    blocks = F.sequence(F.shiftright("first", block_bits), F.shiftright("last", block_bits))
    pieces = cut.withColumn("_block", F.explode(blocks)).select(
        *_PARTITION,
        "_block",
        F.greatest(F.col("first"), F.shiftleft("_block", block_bits)).alias(_POSITION),
        F.col("last").alias("_until"),
    )
    keys = known.select(*DELIVERY_KEY).distinct()
    rows = keys.withColumn("_block", F.shiftright(_POSITION, block_bits)).withColumn("_message", F.lit(True))
    both = rows.unionByName(pieces, allowMissingColumns=True)
    up_to = Window.partitionBy(*_PARTITION, "_block").orderBy(_POSITION, F.col("_message").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    open_ = both.withColumn("_reach", F.max("_until").over(up_to)).where(f"_message AND coalesce(_reach < {_POSITION}, true)")
    named = {c: F.when(~F.col(f"_no_{c}"), F.col(f"_{c}")).alias(c) for c in _PARTITION}
    named |= {_POSITION: F.col(_POSITION)} | {c: F.col(f"_first.{c}").alias(c) for c in others}
    fresh = once.join(_placed(open_).select(*_PLACE, _POSITION), [*_PLACE, _POSITION], "left_semi")
    return fresh.select(*[named[c] for c in messages.columns]).unionByName(messages.where(F.col(_POSITION).isNull()))
