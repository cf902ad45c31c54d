"""What no column holds, as typed values: VARIANT entries, their schema found by aggregation, columns made from it.

The parse of ``silver(rescued=True)`` is done once and stored; a label that appears later becomes a typed column
by reading the stored entries, not the texts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.schemas import DELIVERY_COLUMNS

# A number as JSON writes it: no leading zeros, so that identifiers like 007 stay text.
JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def variant_value(text: Column) -> Column:
    """A number, true or false as such, any other text as a string; NULL stays NULL."""
    plain = text.rlike(JSON_NUMBER) | text.isin("true", "false")
    return F.coalesce(F.try_parse_json(F.when(plain, text)), text.cast("variant"))


def variant_entries(notices: DataFrame) -> DataFrame:
    """``rescued``: the rescued entries as an array of (label, VARIANT value), in the order of the text. Labels may repeat."""
    entries = F.transform(
        "rescued_fields", lambda e: F.struct(e.label.alias("label"), variant_value(e.value).alias("value"))
    )
    return notices.select(*DELIVERY_COLUMNS, entries.alias("rescued"))


def discovered(entries: DataFrame) -> DataFrame:
    """Per label its number of values, of messages that have it, and the narrowest type that holds all its values.

    The type is merged like a sum: partly in each task, then per label, so a label that a third of all messages have is no hot
    spot, and labels found in different batches merge in the same way.
    """
    once = entries.select(F.explode(F.transform("rescued", _first_of_label)).alias("entry"))
    return once.groupBy(F.col("entry.label").alias("label")).agg(
        F.count("*").alias("value_count"),
        F.count_if("entry.first").alias("message_count"),
        F.schema_of_variant_agg("entry.value").alias("value_type"),
    )


def _first_of_label(entry: Column, place: Column) -> Column:
    labels = F.transform("rescued", lambda e: e.label)
    first = F.array_position(labels, entry.label) == place + 1
    return F.struct(entry.label.alias("label"), entry.value.alias("value"), first.alias("first"))


def typed_columns(entries: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Delivery columns and one column per name, of (label, type): the label's first value, NULL if it does not fit.

    A narrow projection of stored entries.
    """

    def column(name: str, label: str, kind: str) -> Column:
        found = F.filter("rescued", lambda e: e.label == label)
        return F.try_variant_get(F.get(found, F.lit(0))["value"], "$", kind).alias(name)

    return entries.select(*DELIVERY_COLUMNS, *[column(name, *what) for name, what in columns.items()])
