"""Bronze stream -> bronze, silver, fact and three dimensions, parsed once per message.

Each micro-batch stores its messages first, so a replay after a change of the parser
needs no source, then silver, and derives the other tables from that written copy:
column-pruned scans instead of more parses. A lost executor re-reads files.

Every output of batch N lives in its own ``batch_id=N`` folder and is written with
overwrite, so a retried batch replaces what its first attempt left behind. A marker is
written last; readers take marked batches only.

Dimensions: within a batch the first notice in arrival order wins; across batches the
earlier batch wins. Rows are combined per key before any shuffle, so a key that fills a
third of the batch is no hot spot, unlike a keyed state store. What a batch reads of earlier
ones are the key columns of a number of folders that grows with its logarithm.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from notice_lake.operators.layers import DIMENSIONS, dimension, fact, silver
from notice_lake.operators.quality import accepted, quarantined
from notice_lake.schemas import BRONZE, GOLD, SILVER, contract
from notice_lake.sources import files
from notice_lake.sources.scratch import new_folder
from notice_lake.sources.tables import conform
from notice_lake.streaming import maintained, segments
from notice_lake.streaming.hops import AVAILABLE_NOW, Trigger, for_each_batch

_BATCH = "batch_id"


def batch_folder(folder: str, table: str, batch_id: int) -> str:
    return f"{folder}/{table}/{_BATCH}={batch_id}"


def last_batch(spark: SparkSession, folder: str) -> int:
    """The newest batch whose outputs are all written; -1 if there is none."""
    return max((int(n) for n in files.names(spark, f"{folder}/done") if n.isdigit()), default=-1)


def commit(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Mark a batch as done. Of the markers before only the last stays."""
    before = [int(n) for n in files.names(spark, f"{folder}/done") if n.isdigit()]
    files.mark(spark, f"{folder}/done/{batch_id}")
    for old in before:
        if old < batch_id - 1:
            files.remove(spark, f"{folder}/done/{old}")


def read_output(spark: SparkSession, folder: str, table: str, *, algo: str = "hash") -> DataFrame:
    """All rows of ``table`` from batches that are done. ``algo`` is that of the keys."""
    done = last_batch(spark, folder)
    if table in DIMENSIONS:
        schema = contract(GOLD[table].schema, algo=algo)
        return segments.read(spark, f"{folder}/{table}", schema, DIMENSIONS[table][1], done + 1)
    return spark.read.parquet(f"{folder}/{table}").filter(F.col(_BATCH) <= done).drop(_BATCH)


def read_report(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A report over all batches that are done, of which there must be one, made from partial aggregates alone."""
    report = maintained.REPORTS[name]
    done = last_batch(spark, folder)
    if done < 0:
        raise ValueError(f"no batch of {folder} is done")
    return report.finish(maintained.read(spark, f"{folder}/reports/{name}", report, done + 1))


def _store(df: DataFrame, folder: str, table: str, batch_id: int) -> DataFrame:
    path = batch_folder(folder, table, batch_id)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def add_new_members(
    notices: DataFrame, folder: str, table: str, batch_id: int, *, algo: str = "hash"
) -> None:
    """Append the dimension rows of one batch whose key no earlier batch wrote."""
    add_new_rows(dimension(notices, table, algo=algo), folder, table, batch_id, algo=algo)


def add_new_rows(members: DataFrame, folder: str, table: str, batch_id: int, *, algo: str = "hash") -> None:
    """Append those of a batch's dimension rows, one per key, whose key no earlier batch wrote."""
    spark, key = members.sparkSession, DIMENSIONS[table][1]
    target, scratch = f"{folder}/{table}", new_folder(spark, "members")
    rows = conform(members, contract(GOLD[table].schema, algo=algo))
    segments.with_bucket(rows, key, segments.top_level(batch_id)).write.parquet(scratch)
    try:
        candidates = spark.read.parquet(scratch)
        # At most as many rows as there are buckets.
        touched = [r[0] for r in candidates.select(segments.BUCKET).distinct().collect()]
        only_key = T.StructType([rows.schema[key]])
        known = segments.read(spark, target, only_key, key, batch_id, touched)
        fresh = candidates.drop(segments.BUCKET).join(known, key, "left_anti")
        segments.write(fresh.select(*rows.columns), target, batch_id)
    finally:
        files.remove(spark, scratch)
    segments.merge(spark, target, rows.schema, key, batch_id)


def write_batch(
    messages: DataFrame,
    batch_id: int,
    *,
    folder: str,
    algo: str = "hash",
    quarantine: bool = False,
    keep_reports: bool = False,
) -> None:
    """All outputs of one micro-batch, each by its contract. Safe to repeat with the same batch id."""
    clock = messages.schema["kafka_timestamp"].dataType
    raw = _store(conform(messages, contract(BRONZE, clock=clock)), folder, "bronze", batch_id)
    parsed = silver(raw, evidence=quarantine)
    if not quarantine:
        parsed = conform(parsed, contract(SILVER, clock=clock))
    parsed = _store(parsed, folder, "silver", batch_id)
    if quarantine:
        _store(quarantined(parsed), folder, "quarantine", batch_id)
        parsed = accepted(parsed)
    facts = conform(
        fact(parsed, algo=algo), contract(GOLD["fact_notices"].schema, algo=algo, clock=clock)
    )
    facts = _store(facts, folder, "fact_notices", batch_id)
    for table in DIMENSIONS:
        add_new_members(parsed, folder, table, batch_id, algo=algo)
    if keep_reports:
        written = {"bronze": raw, "silver": parsed, "fact_notices": facts}
        for name, report in maintained.REPORTS.items():
            maintained.add(written[report.table], f"{folder}/reports/{name}", report, batch_id)
    commit(messages.sparkSession, folder, batch_id)


def start_fan_out(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    algo: str = "hash",
    quarantine: bool = False,
    keep_reports: bool = False,
    trigger: Trigger = AVAILABLE_NOW,
) -> StreamingQuery:
    """Run ``write_batch`` over a bronze stream. A new checkpoint needs an empty folder.

    With ``quarantine`` silver keeps every row and says why it is suspect; suspect
    rows are copied to ``quarantine``, with their text as delivered, normalised text and
    rescued entries, and stay out of fact, dimensions and reports on silver.

    With ``keep_reports`` each batch also adds to the reports of ``maintained``; ``read_report`` reads them.
    """
    write = partial(write_batch, folder=folder, algo=algo, quarantine=quarantine, keep_reports=keep_reports)
    return for_each_batch(messages, write, checkpoint, trigger=trigger)
