"""Expectations with an action, and quarantine of messages that did not parse."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Predicate = str | Column


# Expectations on the notice text: required trigger, usable delivery data, position.
NOTICE_EXPECTATIONS: dict[str, Predicate] = {
    "trigger_present": "TRIGGER_NUM IS NOT NULL",
    "valid_delivery": "kafka_topic IS NOT NULL AND kafka_partition >= 0 AND kafka_offset >= 0"
    " AND kafka_timestamp IS NOT NULL",
    "parsed": "TITLE IS NOT NULL AND NOTICE_DATE IS NOT NULL",
    "position_present": "GRB_RA IS NOT NULL AND GRB_DEC IS NOT NULL",
}

# Expectations on the fact: angles in degrees within their possible range.
FACT_EXPECTATIONS: dict[str, Predicate] = {
    "trigger_present": "trigger_num IS NOT NULL",
    "error_in_range": "grb_error_deg BETWEEN 0 AND 180",
    "phi_in_range": "grb_phi_deg >= 0 AND grb_phi_deg < 360",
    "theta_in_range": "grb_theta_deg BETWEEN 0 AND 180",
    "sun_dist_in_range": "sun_dist_deg BETWEEN 0 AND 180",
    "moon_dist_in_range": "moon_dist_deg BETWEEN 0 AND 180",
}


def _holds(predicate: Predicate) -> Column:
    """The predicate as true/false; an unknown (NULL) outcome has not been met."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(condition, F.lit(False))


def expect(
    df: DataFrame,
    expectations: Mapping[str, Predicate],
    *,
    action: str = "warn",
    observe: str | Observation | None = None,
) -> DataFrame:
    """Apply expectations to a batch or stream.

    ``warn`` keeps every row, ``drop`` keeps rows meeting all expectations,
    ``fail`` stops the query at the first row that breaks one. ``observe`` counts
    breaches per expectation (all rows seen, before any drop) as observed metrics.
    """
    holds = {name: _holds(p) for name, p in expectations.items()}
    if observe is not None:
        df = df.observe(
            observe,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(~ok).alias(name) for name, ok in holds.items()],
        )
    if action == "warn":
        return df
    if action == "drop":
        return df.filter(reduce(Column.__and__, holds.values()))
    if action == "fail":
        checks = [
            F.when(ok, True).otherwise(F.raise_error(F.lit(f"expectation {name} not met")).cast("boolean"))
            for name, ok in holds.items()
        ]
        return df.filter(reduce(Column.__and__, checks))
    raise ValueError(f"unknown action {action!r}")


def expectation_report(df: DataFrame, expectations: Mapping[str, Predicate]) -> DataFrame:
    """Rows meeting and breaking each expectation, from one pass over the data."""
    names = list(expectations)
    counts = df.agg(
        F.count("*").alias("_total"),
        *[F.count_if(_holds(p)).alias(name) for name, p in expectations.items()],
    )
    return counts.unpivot(["_total"], names, "expectation", "passed").select(
        "expectation", "passed", (F.col("_total") - F.col("passed")).alias("failed")
    )


def quarantined(notices: DataFrame) -> DataFrame:
    """Rows of a ``silver(..., evidence=True)`` table that did not parse cleanly, with their texts."""
    return notices.filter(F.col("parse_issue").isNotNull())


def accepted(notices: DataFrame) -> DataFrame:
    """The other rows; with ``quarantined`` they are the input, each row once."""
    evidence = ("parse_issue", "kafka_value", "single_line_text", "rescued_fields")
    return notices.filter(F.col("parse_issue").isNull()).drop(*evidence)
