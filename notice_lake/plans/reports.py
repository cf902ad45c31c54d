"""Reports on silver and gold tables, each a function of its input tables.

Ties are broken by the delivery key: a LIMIT always returns the same rows, and a
full sort range-partitions finely even if a third of all rows share a timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.schemas import DELIVERY_KEY


def newest_first(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}kafka_timestamp").desc_nulls_last()] + [
        F.col(f"{prefix}{c}").asc_nulls_last() for c in DELIVERY_KEY
    ]


def accuracy_by_algorithm(fact: DataFrame) -> DataFrame:
    """Localisation error per algorithm over notices that state one."""
    error = F.col("grb_error_deg")
    return (
        fact.filter(error.isNotNull())
        .groupBy("loc_algorithm")
        .agg(
            F.count("*").alias("notices"),
            F.round(F.avg(error), 4).alias("avg_error_deg"),
            F.min(error).alias("min_error_deg"),
            F.max(error).alias("max_error_deg"),
        )
        .orderBy(F.desc("notices"), F.col("loc_algorithm").asc_nulls_last())
    )


def activity_by_partition(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("kafka_partition")
        .agg(
            F.count("*").alias("notices"),
            F.min("kafka_offset").alias("first_offset"),
            F.max("kafka_offset").alias("latest_offset"),
            F.max("kafka_timestamp").alias("latest_event"),
        )
        .orderBy("kafka_partition")
    )


def latest_by_partition(messages: DataFrame) -> DataFrame:
    return messages.groupBy("kafka_partition").agg(
        F.max("kafka_offset").alias("latest_offset"),
        F.max("kafka_timestamp").alias("latest_timestamp"),
    )


def parse_quality(notices: DataFrame) -> DataFrame:
    """Counters of missing fields; the sums are NULL for an empty table, as SUM is."""

    def missing(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    return notices.agg(
        F.count("*").alias("total_notices"),
        missing(F.col("TRIGGER_NUM").isNull()).alias("missing_trigger"),
        missing(F.col("GRB_RA").isNull() | F.col("GRB_DEC").isNull()).alias("missing_position"),
        missing(F.col("NOTICE_DATE").isNull()).alias("missing_notice_date"),
    )


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Row count per named layer. Counts prove delivery, not parsing: see parse_quality."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, df in layers.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def fact_with_timing(fact: DataFrame, timing: DataFrame) -> DataFrame:
    """Every notice with its burst date and time, newest first."""
    return (
        fact.alias("f")
        .join(timing.alias("t"), F.col("f.timing_sk") == F.col("t.timing_sk"), "left")
        .orderBy(*newest_first("f."))
        .select(
            "f.trigger_num", "f.record_num", "t.grb_date_raw", "t.grb_time_raw",
            "f.grb_error_deg", "f.loc_algorithm",
        )
    )


def recent_bursts(fact: DataFrame, spatial: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest notices with a known position; a distributed top-k."""
    return (
        fact.alias("f")
        .join(spatial.alias("s"), F.col("f.spatial_sk") == F.col("s.spatial_sk"))
        .orderBy(*newest_first("f."))
        .limit(n)
        .select(
            "f.trigger_num", "f.kafka_timestamp", "s.right_ascension", "s.declination",
            "s.galactic_coords", "f.grb_error_deg", "f.location_url",
        )
    )


def burst_sun_moon_context(fact: DataFrame, spatial: DataFrame, sun_moon: DataFrame) -> DataFrame:
    """Every positioned notice with Sun/Moon context, newest first.

    The two dimensions are joined first: the second join only reads the spatial
    row, so the order is free, and this way the fact is shuffled once, not twice.
    """
    places = (
        spatial.alias("s")
        .join(sun_moon.alias("m"), F.col("s.sun_moon_sk") == F.col("m.sun_moon_sk"), "left")
        .select(
            "s.spatial_sk", "s.right_ascension", "s.declination", "s.galactic_coords",
            "m.sun_position", "m.moon_position", "m.moon_illumination",
        )
    )
    return (
        fact.alias("f")
        .join(places.alias("p"), F.col("f.spatial_sk") == F.col("p.spatial_sk"))
        .orderBy(*newest_first("f."))
        .select(
            "f.trigger_num", "f.kafka_timestamp", "p.right_ascension", "p.declination",
            "p.galactic_coords", "p.sun_position", "p.moon_position", "p.moon_illumination",
            "f.sun_dist_deg", "f.moon_dist_deg",
        )
    )


def latest_raw(messages: DataFrame, n: int = 10) -> DataFrame:
    return (
        messages.orderBy(*newest_first())
        .limit(n)
        .select("kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_value")
    )


def parsed_sample(notices: DataFrame, n: int = 20) -> DataFrame:
    """``n`` parsed notices to look at, always the same ones: the first delivered."""
    return (
        notices.orderBy(*DELIVERY_KEY)
        .limit(n)
        .select("TRIGGER_NUM", "RECORD_NUM", "GRB_RA", "GRB_DEC", "GRB_ERROR", "NOTICE_DATE")
    )
