"""Lag of running streams, from what each trigger reports.

``ProgressLog`` listens to the streaming queries of a session and writes one small file per trigger. ``offsets``
reads them as rows: per source and feed partition, where the trigger started, where it ended and how far the feed had got. No end offsets are
made by hand. Offsets come in the forms that sources use: topic -> partition -> offset, or one number for a file source,
which then stands for the source as a whole (NULL topic and partition).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from notice_lake.schemas import DELIVERY_KEY
from notice_lake.sources import files

_PART = list(DELIVERY_KEY[:2])
_SOURCE = ["query_id", "source", *_PART]
_TRIGGER = (
    "query_id string, run_id string, query_name string, batch_id long, at string,"
    " source int, description string, rows long, start_json string, end_json string, latest_json string"
)


def trigger_rows(progress: dict) -> list[dict]:
    """One row per source of a progress report, offsets as JSON text."""

    def text(offset) -> str | None:
        if offset is None or isinstance(offset, str):
            return offset
        return json.dumps(offset)

    return [
        {
            "query_id": progress["id"],
            "run_id": progress["runId"],
            "query_name": progress.get("name"),
            "batch_id": progress["batchId"],
            "at": progress["timestamp"],
            "source": number,
            "description": source.get("description"),
            "rows": source.get("numInputRows"),
            "start_json": text(source.get("startOffset")),
            "end_json": text(source.get("endOffset")),
            "latest_json": text(source.get("latestOffset")),
        }
        for number, source in enumerate(progress["sources"])
    ]


class ProgressLog(StreamingQueryListener):
    """Add with ``spark.streams.addListener``. A trigger is one file under its day: writing it again replaces it.

    The driver writes as many lines as the query has sources. An idle trigger that repeats its batch number is kept as well,
    by its time: it is what shows that a feed went on and the query did not.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.write(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def catch_up(self, query: StreamingQuery) -> None:
        """Write what a query still remembers of its triggers: reports reach a listener some time after the trigger."""
        for progress in query.recentProgress:
            self.write(json.loads(progress.json))

    def write(self, progress: dict) -> None:
        rows = trigger_rows(progress)
        at = progress["timestamp"]
        name = f"{progress['id']}-{progress['batchId']}-{at.replace(':', '')}.json"
        text = "".join(json.dumps(row) + "\n" for row in rows)
        files.write_text(self.spark, f"{self.folder}/day={at[:10]}/{name}", text)


def read_triggers(spark: SparkSession, folder: str) -> DataFrame:
    """Everything logged, one row per trigger and source."""
    return spark.read.schema(_TRIGGER).json(folder).withColumn("at", F.col("at").cast("timestamp"))


def _by_partition(text: str) -> Column:
    """(topic, partition, offset) of each feed partition in an offset text."""
    nested = F.from_json(text, "map<string, map<string, bigint>>")
    # A number by itself, or a file source's {"logOffset": n}.
    single = F.coalesce(F.col(text).try_cast("long"), F.get_json_object(text, "$.logOffset").try_cast("long"))
    entry = "struct<kafka_topic: string, kafka_partition: int, offset: bigint>"
    rows = F.flatten(
        F.transform(
            F.map_entries(nested),
            lambda t: F.transform(
                F.map_entries(t.value),
                lambda p: F.struct(
                    t.key.alias("kafka_topic"), p.key.cast("int").alias("kafka_partition"), p.value.alias("offset")
                ),
            ),
        )
    )
    whole = F.array(F.struct(F.lit(None).cast("string").alias("kafka_topic"), F.lit(None).cast("int").alias("kafka_partition"), single.alias("offset")))
    return F.when(single.isNotNull(), whole.cast(f"array<{entry}>")).otherwise(
        F.coalesce(rows.cast(f"array<{entry}>"), F.array().cast(f"array<{entry}>"))
    )


def offsets(triggers: DataFrame) -> DataFrame:
    """Per trigger, source and feed partition: start, end and latest offset, NULL where a report has none.

    A source that does not report how far its feed got counts as read to the end of the trigger. Narrow: no shuffle.
    """
    kinds = {"start_offset": "start_json", "end_offset": "end_json", "latest_offset": "latest_json"}
    rows = triggers.withColumns({f"_{k}": _by_partition(text) for k, text in kinds.items()})
    every = F.array_distinct(
        F.concat(*[F.transform(f"_{k}", lambda o: F.struct(o.kafka_topic.alias("kafka_topic"), o.kafka_partition.alias("kafka_partition"))) for k in kinds])
    )

    def offset(kind: str) -> Column:
        same = F.filter(
            f"_{kind}",
            lambda o: o.kafka_topic.eqNullSafe(F.col("_part.kafka_topic")) & o.kafka_partition.eqNullSafe(F.col("_part.kafka_partition")),
        )
        return F.get(same, F.lit(0)).offset

    return (
        rows.withColumn("_part", F.explode(every))
        .select(
            "query_id", "query_name", "run_id", "batch_id", "at", "source", "_part.*",
            *[offset(k).alias(k) for k in kinds],
        )
        .withColumn("latest_offset", F.coalesce("latest_offset", "end_offset"))
    )


def live_lag(offsets: DataFrame) -> DataFrame:
    """As of the newest trigger of each source: what is left to read per feed partition, and since when nothing was read.

    ``unmoved_since`` is the first trigger that ended where the newest one did, or NULL if nothing was ever read.
    """
    newest = F.struct("at", "batch_id", "end_offset", "latest_offset")
    # As many rows per partition as it had different ends; then one.
    ends = offsets.groupBy(*_SOURCE, "end_offset").agg(F.min("at").alias("_since"), F.max(newest).alias("_newest"))
    last = ends.groupBy(*_SOURCE).agg(F.max(F.struct("_newest", "_since")).alias("_last"))
    end, latest = F.col("_last._newest.end_offset"), F.col("_last._newest.latest_offset")
    return last.select(
        *_SOURCE,
        F.col("_last._newest.at").alias("at"),
        end.alias("end_offset"),
        latest.alias("latest_offset"),
        (latest - F.coalesce(end, F.lit(0))).alias("lag"),
        F.when(end.isNotNull(), F.col("_last._since")).alias("unmoved_since"),
    )


def stalled(lag: DataFrame, patience: str) -> DataFrame:
    """Rows of ``live_lag`` with something to read and no move for longer than ``patience`` (``10 MINUTES``)."""
    still = F.col("unmoved_since").isNull() | (F.col("unmoved_since") + F.expr(f"INTERVAL {patience}") < F.col("at"))
    return lag.filter((F.col("lag") > 0) & still)
