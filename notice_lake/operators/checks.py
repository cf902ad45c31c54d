"""Key, reference and delivery checks. Each returns the violations as rows.

Every check counts per key before it compares or joins, so a key shared by a
third of all rows has shrunk to one partial row per task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notice_lake.functions import notice_text as nt
from notice_lake.schemas import DELIVERY_KEY, GOLD, NOTICE_FIELDS, TableContract


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def primary_key_violations(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract] = GOLD
) -> DataFrame:
    """Duplicate primary keys of every given table that declares one."""
    found = [
        duplicate_keys(tables[name], contract.primary_key).select(
            F.lit(name).alias("table_name"),
            F.concat_ws(",", *contract.primary_key).alias("key_value"),
            "copies",
        )
        for name, contract in contracts.items()
        if contract.primary_key and name in tables
    ]
    return _union(found)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys without a parent row, and how many child rows hold each."""
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key_value"))
        .agg(F.count("*").alias("child_rows"))
    )
    known = parent.select(F.col(parent_column).alias("key_value"))
    return used.join(known, "key_value", "left_anti")


def foreign_key_violations(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract] = GOLD
) -> DataFrame:
    """Orphan keys of every declared reference whose two tables are given."""
    return _union(
        [
            orphan_keys(tables[name], column, tables[parent], parent_column).select(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.col("key_value").cast("string").alias("key_value"),
                "child_rows",
            )
            for name, column, parent, parent_column in _references(tables, contracts)
        ]
    )


def orphan_counts(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, TableContract] = GOLD
) -> DataFrame:
    """Orphan keys and orphan rows per declared reference, zeros included."""
    return _union(
        [
            orphan_keys(tables[name], column, tables[parent], parent_column).agg(
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows"),
            ).select(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(parent).alias("parent_table"),
                "orphan_keys",
                "orphan_rows",
            )
            for name, column, parent, parent_column in _references(tables, contracts)
        ]
    )


def not_null_violations(
    df: DataFrame, columns: Sequence[str], identity: Sequence[str] = DELIVERY_KEY
) -> DataFrame:
    """One row per (row identity, required column) that is NULL; a narrow scan."""
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]),
        lambda c: c.isNotNull(),
    )
    return df.select(*identity, F.explode(missing).alias("column_name"))


def duplicate_deliveries(messages: DataFrame) -> DataFrame:
    """Feed positions delivered more than once."""
    return duplicate_keys(messages, DELIVERY_KEY)


def key_reuse(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Keys that stand for more than one combination of ``attributes``.

    With a table's natural key this finds hash collisions, with its other
    attributes the values a first-seen dimension would hide.
    """
    variants = df.groupBy(key, *attributes).agg(F.count("*").alias("_rows"))
    return (
        variants.groupBy(key)
        .agg(F.count("*").alias("variants"), F.sum("_rows").alias("row_count"))
        .filter(F.col("variants") > 1)
    )


def parse_null_pct(notices: DataFrame, fields: Sequence[str] = NOTICE_FIELDS) -> DataFrame:
    """Share of NULLs per field, in percent: one pass, then one row per field."""
    counts = notices.agg(
        F.count("*").alias("_total"), *[F.count(F.col(f)).alias(f) for f in fields]
    )
    missing = F.col("_total") - F.col("present")
    return counts.unpivot(["_total"], list(fields), "field", "present").select(
        "field",
        F.col("_total").alias("total"),
        missing.alias("missing"),
        F.round(F.lit(100.0) * missing / F.nullif(F.col("_total"), F.lit(0)), 4).alias("null_pct"),
    )


def malformed_payloads(messages: DataFrame, value: str = "kafka_value") -> DataFrame:
    """Messages whose text is NULL or holds none of the known labels at a line start."""
    known = "|".join(NOTICE_FIELDS)
    text = nt.normalise_spaces(F.col(value))
    reason = F.when(text.isNull(), "null payload").when(
        ~text.rlike(rf"(?:^|\n)(?:{known}):"), "no known label"
    )
    # Exploding none or one reason evaluates it once; a filter would do so twice.
    return messages.select(
        *DELIVERY_KEY, F.explode(F.array_compact(F.array(reason))).alias("reason")
    )


def consumer_lag(messages: DataFrame, end_offsets: DataFrame) -> DataFrame:
    """Messages not yet consumed per partition.

    ``end_offsets`` holds (kafka_topic, kafka_partition, end_offset), the next
    offset each partition will assign. A partition never read lags by all of it.
    """
    consumed = messages.groupBy(*DELIVERY_KEY[:2]).agg(
        F.max("kafka_offset").alias("latest_offset"),
        F.max("kafka_timestamp").alias("latest_timestamp"),
    )
    next_offset = F.coalesce(F.col("latest_offset") + 1, F.lit(0))
    return end_offsets.join(consumed, list(DELIVERY_KEY[:2]), "left").select(
        *DELIVERY_KEY[:2],
        "end_offset",
        "latest_offset",
        "latest_timestamp",
        (F.col("end_offset") - next_offset).alias("lag"),
    )


def stalled_offsets(earlier: DataFrame, later: DataFrame) -> DataFrame:
    """Partitions whose consumer did not move between two snapshots while the feed did.

    A snapshot holds (kafka_topic, kafka_partition, latest_offset, end_offset), as
    ``consumer_lag`` returns them; ``latest_offset`` is NULL where nothing was read. A partition
    that only the later snapshot has counts as empty and unread in the earlier one.
    """
    part = list(DELIVERY_KEY[:2])
    before = earlier.select(*part, F.col("latest_offset").alias("_latest"), F.col("end_offset").alias("_end"))
    added = F.col("end_offset") - F.coalesce("_end", F.lit(0))
    return (
        later.join(before, part, "left")
        .filter(F.col("latest_offset").eqNullSafe(F.col("_latest")) & (added > 0))
        .select(*part, "latest_offset", "end_offset", added.alias("added"))
    )


def _references(tables, contracts):
    return [
        (name, *reference)
        for name, contract in contracts.items()
        for reference in contract.references
        if name in tables and reference[1] in tables
    ]


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("no given table has a matching contract")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
