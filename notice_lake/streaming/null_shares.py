"""Share of missing values per field and hour of a running feed, with an event-time watermark.

Each micro-batch counts, per hour of the feed's clock and in one pass, its rows and the values present in each field.
The watermark of a batch is the newest timestamp of all batches before it, less a wait. A row whose hour ended by then is late: it
is counted as late and stays out of the shares, as an hour that was reported as closed does not change. Counts are partial
aggregates of ``maintained``: nothing is kept in a state store, restarts and repeated batches count each row once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from notice_lake.schemas import NOTICE_FIELDS
from notice_lake.streaming import fan_out, maintained
from notice_lake.streaming.hops import AVAILABLE_NOW, Trigger, for_each_batch

# What a timestamp is past the start of its window: hours, minutes, seconds with their fraction.
UNITS = {
    "MINUTE": "0, 0, extract(SECOND FROM {0})",
    "HOUR": "0, extract(MINUTE FROM {0}), extract(SECOND FROM {0})",
    "DAY": "extract(HOUR FROM {0}), extract(MINUTE FROM {0}), extract(SECOND FROM {0})",
}
_TABLE = "null_shares"


def report(fields: Sequence[str] = NOTICE_FIELDS, unit: str = "HOUR") -> maintained.Report:
    """Rows without a timestamp are a window of their own, which is never late and never closed."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {tuple(UNITS)}")
    present = {f: (f"count(CASE WHEN NOT _late THEN `{f}` END)", "sum") for f in fields}
    return maintained.Report(
        _TABLE,
        {"window_start": "_window"},
        {"_rows": ("count_if(NOT _late)", "sum"), "_late": ("count_if(_late)", "sum"), "_newest": ("max(kafka_timestamp)", "max")}
        | present,
    )


def _newest(counts: DataFrame) -> Column:
    """The newest timestamp counted, as a literal; it goes by its text, which holds in any time zone."""
    text = counts.agg(F.max("_newest").cast("string")).first()[0]
    return F.lit(text).cast(counts.schema["_newest"].dataType)


def _passed(start: Column, unit: str, wait: str, newest: Column) -> Column:
    """Whether the window that starts at ``start`` had ended ``wait`` before ``newest``."""
    ended = start + F.expr(f"INTERVAL 1 {unit}") + F.expr(f"INTERVAL {wait}") <= newest
    return F.coalesce(ended, F.lit(False))


def write_batch(notices: DataFrame, batch_id: int, *, folder: str, fields: Sequence[str], unit: str, wait: str) -> None:
    """The counts of one micro-batch. Safe to repeat with the same batch id."""
    spark, what = notices.sparkSession, report(fields, unit)
    target = f"{folder}/{_TABLE}"
    late = F.lit(False)
    if batch_id:
        late = _passed(F.col("_window"), unit, wait, _newest(maintained.read(spark, target, what, batch_id)))
    into = UNITS[unit].format("kafka_timestamp")
    rows = notices.withColumn("_window", F.expr(f"kafka_timestamp - make_dt_interval(0, {into})"))
    rows = rows.withColumn("_late", late)
    maintained.add(rows, target, what, batch_id)
    fan_out.commit(spark, folder, batch_id)


def start_null_shares(
    notices: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    fields: Sequence[str] = NOTICE_FIELDS,
    unit: str = "HOUR",
    wait: str = "1 HOUR",
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Run ``write_batch`` over a silver stream. A new checkpoint needs an empty folder."""
    write = partial(write_batch, folder=folder, fields=tuple(fields), unit=unit, wait=wait)
    return for_each_batch(notices, write, checkpoint, trigger=trigger)


def read_windows(
    spark: SparkSession, folder: str, *, fields: Sequence[str] = NOTICE_FIELDS, unit: str = "HOUR", wait: str = "1 HOUR"
) -> DataFrame:
    """Per window: rows counted, rows that came too late, and whether it is closed."""
    counts = _counts(spark, folder, fields, unit)
    closed = _passed(F.col("window_start"), unit, wait, _newest(counts))
    return counts.select("window_start", F.col("_rows").alias("total"), F.col("_late").alias("late"), closed.alias("closed"))


def read_null_shares(
    spark: SparkSession, folder: str, *, fields: Sequence[str] = NOTICE_FIELDS, unit: str = "HOUR"
) -> DataFrame:
    """Per window and field: rows, missing values and their share in percent; NULL where all rows were late."""
    counts = _counts(spark, folder, fields, unit)
    missing = F.col("_rows") - F.col("present")
    return counts.unpivot(["window_start", "_rows"], list(fields), "field", "present").select(
        "window_start",
        "field",
        F.col("_rows").alias("total"),
        missing.alias("missing"),
        F.round(F.lit(100.0) * missing / F.nullif(F.col("_rows"), F.lit(0)), 4).alias("null_pct"),
    )


def _counts(spark: SparkSession, folder: str, fields: Sequence[str], unit: str) -> DataFrame:
    done = fan_out.last_batch(spark, folder)
    if done < 0:
        raise ValueError(f"no batch of {folder} is done")
    return maintained.read(spark, f"{folder}/{_TABLE}", report(fields, unit), done + 1)
