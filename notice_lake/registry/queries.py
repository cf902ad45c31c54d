"""Every operator as a named query over one table folder.

Messages are derived from ``events`` by Spark, so the work grows with that
table. Keys use sha256 where rows are compared with SQL, which has no Murmur3.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_lake.functions.keys import surrogate_key
from notice_lake.operators import checks, intervals, quality, rescued, sequences
from notice_lake.operators.layers import (
    DIMENSIONS,
    bronze,
    dimension,
    fact,
    silver,
    stream_dimension,
)
from notice_lake.operators.near import near_positions
from notice_lake.operators.typed import sky_separation, typed_notice
from notice_lake.plans import reports
from notice_lake.schemas import (
    ARRIVAL_ORDER,
    BRONZE,
    DELIVERY_COLUMNS,
    DELIVERY_KEY,
    FACT_NOTICES,
    SILVER,
    SPATIAL_KEY,
    SUN_MOON_KEY,
    TIMING_KEY,
    contract,
)
from notice_lake.sources import bucketed, synthetic
from notice_lake.sources.scratch import new_folder, stored
from notice_lake.sources.tables import read_files
from notice_lake.streaming import bounded, collisions, deliveries, guard, null_shares, orphans, progress
from notice_lake.streaming.fan_out import read_output, read_report, start_fan_out
from notice_lake.streaming.hops import append_to_files, start_dimension

Query = Callable[[SparkSession, str], DataFrame]

WIDE = "sha256"

# Fixed value: the sky point of the separation query (J2000 degrees).
SKY_POINT = (266.405, -28.936)

# A key short enough that test tables have collisions.
SHORT_KEYS = 65536

# Rescued labels as typed columns.
RESCUED_COLUMNS = {"background": ("BACKGROUND", "bigint"), "foo_bar": ("FOO_BAR", "string"), "odd_one": ("ODD_ONE", "string")}

# Positions at most so many degrees apart are near each other.
NEAR_DEG = 7.3


def _notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(synthetic.notices(spark, sf_dir))


# Notice fields behind the attributes of each dimension.
_TIMING = (*TIMING_KEY, "NOTICE_DATE")
_SPATIAL = (*SPATIAL_KEY, *SUN_MOON_KEY, "ECL_COORDS")
_SUN_MOON = (*SUN_MOON_KEY, "MOON_ILLUM")


def _stored(messages: DataFrame, *fields: str) -> DataFrame:
    """Silver columns written to the shared folder, for queries that read them repeatedly.

    The parse runs once and each reader scans only its columns. Every call writes a
    copy of its own, of the named fields only; ``scratch.release`` deletes them.
    """
    return stored(silver(messages).select(*DELIVERY_COLUMNS, *dict.fromkeys(fields)), "silver")


def _stored_dimension(parsed: DataFrame, table: str) -> DataFrame:
    """A reduced dimension as reports meet it: a table. A join on it splits a hot key of the fact."""
    return stored(dimension(parsed, table, algo=WIDE), table)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(_notices(spark, sf_dir), algo=WIDE)


def _dimension(table: str) -> Query:
    return lambda spark, sf_dir: dimension(_notices(spark, sf_dir), table, algo=WIDE)


def bronze_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(synthetic.kafka_shaped(synthetic.notices(spark, sf_dir)))


def silver_strip_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(synthetic.notices(spark, sf_dir), comments="strip_label")


def silver_irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(synthetic.irregular(spark, sf_dir), issues=True)


def normalised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = silver(synthetic.notices(spark, sf_dir), keep_text=True)
    return parsed.select(*DELIVERY_KEY, "single_line_text")


def rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = silver(synthetic.irregular(spark, sf_dir), rescued=True)
    return parsed.select(*DELIVERY_KEY, F.inline("rescued_fields").alias("field", "value"))


def surrogate_hash_int32(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notices(spark, sf_dir).select(
        *DELIVERY_KEY,
        surrogate_key(*TIMING_KEY).alias("timing_sk"),
        surrogate_key(*SPATIAL_KEY).alias("spatial_sk"),
        surrogate_key(*SUN_MOON_KEY).alias("sun_moon_sk"),
    )


def surrogate_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notices(spark, sf_dir).select(
        *DELIVERY_KEY,
        surrogate_key(*TIMING_KEY, algo=WIDE).alias("timing_sk"),
        surrogate_key(*SPATIAL_KEY, algo=WIDE).alias("spatial_sk"),
        surrogate_key(*SUN_MOON_KEY, algo=WIDE).alias("sun_moon_sk"),
    )


def surrogate_xxhash64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _notices(spark, sf_dir).select(
        *DELIVERY_KEY,
        surrogate_key(*TIMING_KEY, algo="xxhash64").alias("timing_sk"),
        surrogate_key(*SPATIAL_KEY, algo="xxhash64").alias("spatial_sk"),
        surrogate_key(*SUN_MOON_KEY, algo="xxhash64").alias("sun_moon_sk"),
    )


def accuracy_by_algorithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.accuracy_by_algorithm(_fact(spark, sf_dir))


def activity_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.activity_by_partition(_fact(spark, sf_dir))


def latest_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_by_partition(synthetic.notices(spark, sf_dir))


def parse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.parse_quality(_notices(spark, sf_dir))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = synthetic.notices(spark, sf_dir)
    parsed = silver(messages)
    return reports.layer_counts(
        bronze=messages, silver=parsed, fact_notices=fact(parsed, algo=WIDE)
    )


def fact_with_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = synthetic.notices(spark, sf_dir)
    parsed = _stored(messages, *_TIMING, "TRIGGER_NUM", "RECORD_NUM", "GRB_ERROR", "LOC_ALGORITHM")
    columns = [
        "trigger_num", "record_num", *ARRIVAL_ORDER, "timing_sk", "grb_error_deg", "loc_algorithm",
    ]
    return reports.fact_with_timing(
        fact(parsed, algo=WIDE, columns=columns), _stored_dimension(parsed, "dim_event_timing")
    )


def recent_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = synthetic.notices(spark, sf_dir)
    parsed = _stored(messages, *_SPATIAL, "TRIGGER_NUM", "GRB_ERROR", "LOC_URL")
    columns = ["trigger_num", *ARRIVAL_ORDER, "spatial_sk", "grb_error_deg", "location_url"]
    return reports.recent_bursts(
        fact(parsed, algo=WIDE, columns=columns), _stored_dimension(parsed, "dim_spatial_coords")
    )


def burst_sun_moon_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = synthetic.notices(spark, sf_dir)
    parsed = _stored(messages, *_SPATIAL, *_SUN_MOON, "TRIGGER_NUM", "SUN_DIST", "MOON_DIST")
    columns = ["trigger_num", *ARRIVAL_ORDER, "spatial_sk", "sun_dist_deg", "moon_dist_deg"]
    return reports.burst_sun_moon_context(
        fact(parsed, algo=WIDE, columns=columns),
        _stored_dimension(parsed, "dim_spatial_coords"),
        _stored_dimension(parsed, "dim_sun_moon_coords"),
    )


def latest_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_raw(synthetic.notices(spark, sf_dir))


def parsed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.parsed_sample(_notices(spark, sf_dir))


def _unreduced_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimension rows as they come, one per notice: what a lost dedup would publish."""
    parsed = _stored(synthetic.notices(spark, sf_dir), *_TIMING, *_SPATIAL, *_SUN_MOON)
    return {name: rows(parsed, algo=WIDE) for name, (rows, _) in DIMENSIONS.items()}


def _torn_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A fact of all messages beside dimensions built from the damaged feed."""
    damaged = _stored(synthetic.damaged(spark, sf_dir), *_TIMING, *_SPATIAL, *_SUN_MOON)
    tables = {name: _stored_dimension(damaged, name) for name in DIMENSIONS}
    whole = _stored(synthetic.notices(spark, sf_dir), *TIMING_KEY, *SPATIAL_KEY)
    keys = fact(whole, algo=WIDE, columns=["timing_sk", "spatial_sk"])
    return tables | {"fact_notices": keys}


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.primary_key_violations(_unreduced_dimensions(spark, sf_dir))


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.foreign_key_violations(_torn_gold(spark, sf_dir))


def orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.orphan_counts(_torn_gold(spark, sf_dir))


def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["trigger_num", "record_num", "timing_sk", "spatial_sk", "grb_error_deg"]
    return checks.not_null_violations(_fact(spark, sf_dir), columns)


def duplicate_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_deliveries(synthetic.damaged(spark, sf_dir))


def parse_null_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.parse_null_pct(silver(synthetic.irregular(spark, sf_dir)))


def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.offset_gaps(synthetic.damaged(spark, sf_dir))


def late_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.late_messages(synthetic.damaged(spark, sf_dir))


def malformed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.malformed_payloads(synthetic.irregular(spark, sf_dir))


def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timing keys of the contract that stand for more than one date and time."""
    parsed = _notices(spark, sf_dir).withColumn("timing_sk", surrogate_key(*TIMING_KEY))
    return checks.key_reuse(parsed, "timing_sk", TIMING_KEY)


def key_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions seen under more than one Sun/Moon context."""
    rows, key = DIMENSIONS["dim_spatial_coords"]
    return checks.key_reuse(rows(_notices(spark, sf_dir), algo=WIDE), key, ["sun_moon_sk"])


def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag of the damaged feed behind ends 10 offsets per partition number beyond the feed's."""
    ends = (
        synthetic.notices(spark, sf_dir)
        .groupBy("kafka_topic", "kafka_partition")
        .agg(F.max("kafka_offset").alias("_last"))
        .select(
            "kafka_topic",
            "kafka_partition",
            (F.col("_last") + 1 + 10 * F.col("kafka_partition")).alias("end_offset"),
        )
    )
    return checks.consumer_lag(synthetic.damaged(spark, sf_dir), ends)


def stalled_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots when a third and when all of the feed was there.

    Consumers are 5 offsets behind; those of even partitions stop after the first snapshot.
    """
    messages = synthetic.notices(spark, sf_dir)
    last = messages.groupBy("kafka_topic", "kafka_partition").agg(F.max("kafka_offset").alias("last"))
    first_end = F.floor(F.col("last") / 3)
    part = ["kafka_topic", "kafka_partition"]
    earlier = last.select(*part, (first_end - 5).alias("latest_offset"), first_end.alias("end_offset"))
    stopped = F.col("kafka_partition") % 2 == 0
    later = last.select(
        *part,
        F.when(stopped, first_end - 5).otherwise(F.col("last") - 4).alias("latest_offset"),
        (F.col("last") + 1).alias("end_offset"),
    )
    return checks.stalled_offsets(earlier, later)


def expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectation_report(
        silver(synthetic.irregular(spark, sf_dir)), quality.NOTICE_EXPECTATIONS
    )


def fact_expectation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expectation_report(_fact(spark, sf_dir), quality.FACT_EXPECTATIONS)


def expected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notices left when rows breaking an expectation are dropped."""
    return quality.expect(
        silver(synthetic.irregular(spark, sf_dir)), quality.NOTICE_EXPECTATIONS, action="drop"
    )


def _with_entry_lines(notices: DataFrame) -> DataFrame:
    """Rescued entries as one text, a line per entry."""
    lines = F.transform("rescued_fields", lambda e: F.concat(e.label, F.lit("="), e.value))
    return notices.withColumn("rescued_text", F.array_join(lines, "\n")).drop("rescued_fields")


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that did not parse cleanly, with all that is known about them."""
    parsed = silver(synthetic.irregular(spark, sf_dir), evidence=True)
    return _with_entry_lines(quality.quarantined(parsed))


def accepted_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted(silver(synthetic.irregular(spark, sf_dir), evidence=True))


def typed_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_notice(silver(synthetic.shaped(spark, sf_dir)))


def sky_separations(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = sky_separation(typed_notice(_notices(spark, sf_dir)), *SKY_POINT)
    return near.withColumn("separation_deg", F.round("separation_deg", 6))


def fact_own_sun_moon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each notice's own Sun/Moon key beside the one its position was first seen with."""
    parsed = _stored(synthetic.notices(spark, sf_dir), *_SPATIAL)
    columns = [*DELIVERY_KEY, "spatial_sk", "sun_moon_sk"]
    own = fact(parsed, algo=WIDE, with_sun_moon=True, columns=columns)
    first = _stored_dimension(parsed, "dim_spatial_coords")
    return own.join(
        first.select("spatial_sk", F.col("sun_moon_sk").alias("first_sun_moon_sk")), "spatial_sk"
    ).select(*DELIVERY_KEY, "sun_moon_sk", "first_sun_moon_sk")


def positions_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of positions near each other, with the number of notices of each."""
    near = near_positions(typed_notice(_notices(spark, sf_dir)), NEAR_DEG)
    return near.withColumn("separation_deg", F.round("separation_deg", 6))


def _rescued_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What no column holds, stored as VARIANT values."""
    return stored(rescued.variant_entries(silver(synthetic.irregular(spark, sf_dir), rescued=True)), "rescued")


def rescued_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rescued.discovered(_rescued_entries(spark, sf_dir))


def rescued_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rescued.typed_columns(_rescued_entries(spark, sf_dir), RESCUED_COLUMNS).select(*DELIVERY_KEY, *RESCUED_COLUMNS)


def bucketed_fact_with_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact and timing stored by buckets of their key and joined bucket by bucket."""
    parsed = _stored(synthetic.notices(spark, sf_dir), *_TIMING, "TRIGGER_NUM", "RECORD_NUM", "GRB_ERROR", "LOC_ALGORITHM")
    columns = ["trigger_num", "record_num", *DELIVERY_KEY, "timing_sk", "grb_error_deg", "loc_algorithm"]
    facts = stored(fact(parsed, algo=WIDE, columns=columns), "fact")
    pair = bucketed.write_pair(facts, dimension(parsed, "dim_event_timing", algo=WIDE), "timing_sk")
    return bucketed.joined(spark, pair).select(
        "trigger_num", "record_num", "grb_date_raw", "grb_time_raw", "grb_error_deg", "loc_algorithm"
    )


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synthetic.notices_from(synthetic.events_stream(spark, sf_dir))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-silver")
    out = f"{folder}/silver"
    append_to_files(
        silver(_message_stream(spark, sf_dir)), out, f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(out)


def _stream_dimension(table: str, *columns: str) -> Query:
    """Keys and key attributes from state-store dedup; other attributes depend on arrival order."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "stream-dims")
        parsed = silver(_message_stream(spark, sf_dir))
        start_dimension(
            parsed, table, f"{folder}/dim", f"{folder}/checkpoint", algo=WIDE, columns=columns
        ).awaitTermination()
        return spark.read.parquet(f"{folder}/dim")

    return query


def stream_dims_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and key attributes of a dimension whose stream forgets keys."""
    folder, table = new_folder(spark, "stream-bounded"), "dim_spatial_coords"
    parsed = silver(_message_stream(spark, sf_dir))
    bounded.start_bounded_dimension(parsed, table, folder, f"{folder}/checkpoint", algo=WIDE).awaitTermination()
    rows = bounded.read_dimension(spark, folder, table, algo=WIDE)
    return rows.select("spatial_sk", "right_ascension", "declination", "galactic_coords")


def _taken_once(spark: SparkSession, sf_dir: str) -> str:
    """The feed after a bad day, delivered in parts that overlap, through the stream that takes each delivery once."""
    folder, feed = new_folder(spark, "deliveries"), synthetic.damaged(spark, sf_dir)
    for some in ("kafka_offset % 3 = 0", "true", "kafka_offset % 2 = 0"):
        feed.where(some).write.mode("append").parquet(f"{folder}/feed")
    stream = read_files(spark, f"{folder}/feed", schema=feed.schema, streaming=True, max_files_per_trigger=4)
    deliveries.start_deliveries(stream, folder, f"{folder}/checkpoint").awaitTermination()
    return folder


def stream_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each offset once, from a feed with copies and with whole parts delivered again."""
    schema = synthetic.damaged(spark, sf_dir).schema
    return deliveries.read_messages(spark, _taken_once(spark, sf_dir), schema).select(*DELIVERY_KEY, "kafka_key", "kafka_value")


def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holes that are left when all is delivered, and which of them are given up."""
    clock = synthetic.damaged(spark, sf_dir).schema["kafka_timestamp"].dataType
    return intervals.holes(deliveries.read_index(spark, _taken_once(spark, sf_dir), clock), "1 DAY")


def stream_hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, silver and fact, one streaming query each, stopped and started again."""
    folder = new_folder(spark, "stream-hops")
    messages = synthetic.notices(spark, sf_dir)
    clock = messages.schema["kafka_timestamp"].dataType
    contracts = {
        "bronze": contract(BRONZE, clock=clock),
        "silver": contract(SILVER, clock=clock),
        "fact": contract(FACT_NOTICES, algo=WIDE, clock=clock),
    }

    def append(df: DataFrame, layer: str) -> None:
        path = f"{folder}/{layer}"
        append_to_files(df, path, f"{path}-checkpoint", schema=contracts[layer]).awaitTermination()

    def stream(layer: str) -> DataFrame:
        return read_files(spark, f"{folder}/{layer}", schema=contracts[layer], streaming=True)

    for _ in range(2):
        append(_message_stream(spark, sf_dir), "bronze")
        append(silver(stream("bronze")), "silver")
        append(fact(stream("silver"), algo=WIDE), "fact")
    return spark.read.parquet(f"{folder}/fact")


def _streamed_gold(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "stream-fan-out")
    start_fan_out(
        _message_stream(spark, sf_dir), folder, f"{folder}/checkpoint", algo=WIDE
    ).awaitTermination()
    return folder


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact joined with all three dimensions, everything written by one stream."""
    folder = _streamed_gold(spark, sf_dir)
    return reports.burst_sun_moon_context(
        read_output(spark, folder, "fact_notices", algo=WIDE),
        read_output(spark, folder, "dim_spatial_coords", algo=WIDE),
        read_output(spark, folder, "dim_sun_moon_coords", algo=WIDE),
    )


def stream_fanout_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _streamed_gold(spark, sf_dir)
    return read_output(spark, folder, "dim_event_timing", algo=WIDE)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine table of a fan-out over the irregular feed."""
    folder = new_folder(spark, "stream-quarantine")
    messages = synthetic.irregular_from(synthetic.events_stream(spark, sf_dir))
    start_fan_out(
        messages, folder, f"{folder}/checkpoint", algo=WIDE, quarantine=True
    ).awaitTermination()
    return _with_entry_lines(read_output(spark, folder, "quarantine"))


def _kept_report(name: str) -> Query:
    """A report from the partial aggregates of a fan-out."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = new_folder(spark, "stream-reports")
        messages = _message_stream(spark, sf_dir)
        start_fan_out(messages, folder, f"{folder}/checkpoint", algo=WIDE, keep_reports=True).awaitTermination()
        return read_report(spark, folder, name)

    return query


def stream_null_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null shares per hour of an irregular feed, a third of which comes when all else was there: most of it too late."""
    folder, feed = new_folder(spark, "stream-null-shares"), synthetic.irregular(spark, sf_dir)
    for some in ("kafka_offset % 3 <> 0", "kafka_offset % 3 = 0"):
        feed.where(some).write.mode("append").parquet(f"{folder}/feed")
        stream = read_files(spark, f"{folder}/feed", schema=feed.schema, streaming=True)
        null_shares.start_null_shares(silver(stream), folder, f"{folder}/checkpoint").awaitTermination()
    windows = null_shares.read_windows(spark, folder).select("window_start", "late", "closed")
    return null_shares.read_null_shares(spark, folder).join(windows, "window_start")


def stream_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches that a stream counted while it wrote its rows; no share is at its limit."""
    folder = new_folder(spark, "stream-guarded")
    parsed = silver(synthetic.irregular_from(synthetic.events_stream(spark, sf_dir)))
    guard.start_guarded(
        parsed,
        folder,
        f"{folder}/checkpoint",
        expectations=quality.NOTICE_EXPECTATIONS,
        limits=guard.Limits({name: 0.9 for name in quality.NOTICE_EXPECTATIONS}),
        action="drop",
    ).awaitTermination()
    counts = guard.read_breaches(spark, folder).where("done").groupBy("expectation")
    return counts.agg(F.sum(F.col("row_count") - F.col("failed")).alias("passed"), F.sum("failed").alias("failed"))


def stream_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timing keys of all messages that the timing dimension of the damaged feed does not have, as far as the watermark has come."""
    folder, parsed = new_folder(spark, "stream-orphans"), silver(synthetic.damaged(spark, sf_dir))
    members = DIMENSIONS["dim_event_timing"][0](parsed, algo=WIDE, carry=("kafka_timestamp",))
    members = members.groupBy("timing_sk").agg(F.min("kafka_timestamp").alias("kafka_timestamp"))
    members.write.parquet(f"{folder}/members")
    parents = read_files(spark, f"{folder}/members", schema=members.schema, streaming=True)
    facts = fact(silver(_message_stream(spark, sf_dir)), algo=WIDE, columns=[*DELIVERY_KEY, "kafka_timestamp", "timing_sk"])

    def known(session: SparkSession) -> DataFrame:
        return session.read.parquet(f"{folder}/members").select("timing_sk")

    orphans.start_orphans(
        facts, parents, "timing_sk", "timing_sk", folder, f"{folder}/checkpoint", known=known
    ).awaitTermination()
    return orphans.read_orphans(spark, folder)


def stream_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collisions of a short timing key, from digests that a stream kept."""
    folder = new_folder(spark, "stream-collisions")

    def short(messages: DataFrame) -> DataFrame:
        return silver(messages).withColumn("timing_sk", F.pmod(surrogate_key(*TIMING_KEY), F.lit(SHORT_KEYS)))

    collisions.start_collisions(
        short(_message_stream(spark, sf_dir)), folder, f"{folder}/checkpoint", key="timing_sk", natural=TIMING_KEY
    ).awaitTermination()
    parsed = short(synthetic.notices(spark, sf_dir))
    return collisions.read_collisions(spark, folder, parsed, key="timing_sk", natural=TIMING_KEY)


def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream of messages reported: rows read, and files it had left to read."""
    folder = new_folder(spark, "stream-lag")
    query = append_to_files(_message_stream(spark, sf_dir), f"{folder}/bronze", f"{folder}/checkpoint")
    query.awaitTermination()
    log = progress.ProgressLog(spark, f"{folder}/log")
    log.catch_up(query)
    triggers = progress.read_triggers(spark, log.folder)
    rows = triggers.groupBy("query_id", "source").agg(F.sum("rows").alias("rows_read"))
    lag = progress.live_lag(progress.offsets(triggers))
    return lag.join(rows, ["query_id", "source"]).select("kafka_topic", "kafka_partition", "rows_read", "lag")


QUERIES: dict[str, Query] = {
    "bronze_projection": bronze_projection,
    "silver_notices": _notices,
    "silver_strip_label": silver_strip_label,
    "silver_irregular": silver_irregular,
    "normalised_text": normalised_text,
    "rescued_fields": rescued_fields,
    "fact_notices": _fact,
    "fact_own_sun_moon": fact_own_sun_moon,
    "dim_timing": _dimension("dim_event_timing"),
    "dim_spatial": _dimension("dim_spatial_coords"),
    "dim_sun_moon": _dimension("dim_sun_moon_coords"),
    "surrogate_hash_int32": surrogate_hash_int32,
    "surrogate_xxhash64": surrogate_xxhash64,
    "surrogate_wide": surrogate_wide,
    "accuracy_by_algorithm": accuracy_by_algorithm,
    "activity_by_partition": activity_by_partition,
    "latest_by_partition": latest_by_partition,
    "parse_quality": parse_quality,
    "layer_counts": layer_counts,
    "fact_with_timing": fact_with_timing,
    "recent_bursts": recent_bursts,
    "burst_sun_moon_context": burst_sun_moon_context,
    "latest_raw": latest_raw,
    "parsed_sample": parsed_sample,
    "pk_violations": pk_violations,
    "fk_orphans": fk_orphans,
    "orphan_counts": orphan_counts,
    "not_null_violations": not_null_violations,
    "duplicate_deliveries": duplicate_deliveries,
    "parse_null_pct": parse_null_pct,
    "offset_gaps": offset_gaps,
    "late_messages": late_messages,
    "malformed_payloads": malformed_payloads,
    "key_collisions": key_collisions,
    "key_reuse": key_reuse,
    "consumer_lag": consumer_lag,
    "stalled_offsets": stalled_offsets,
    "expectation_report": expectation_report,
    "fact_expectation_report": fact_expectation_report,
    "expected_rows": expected_rows,
    "quarantine": quarantine,
    "accepted_notices": accepted_notices,
    "typed_notices": typed_notices,
    "sky_separations": sky_separations,
    "near_positions": positions_near,
    "rescued_schema": rescued_schema,
    "rescued_typed": rescued_typed,
    "bucketed_fact_with_timing": bucketed_fact_with_timing,
    "stream_silver": stream_silver,
    "stream_dims": _stream_dimension(
        "dim_sun_moon_coords", "sun_moon_sk", "sun_position", "moon_position"
    ),
    "stream_dim_timing": _stream_dimension(
        "dim_event_timing", "timing_sk", "grb_date_raw", "grb_time_raw"
    ),
    "stream_dim_spatial": _stream_dimension(
        "dim_spatial_coords", "spatial_sk", "right_ascension", "declination", "galactic_coords"
    ),
    "stream_dims_bounded": stream_dims_bounded,
    "stream_deliveries": stream_deliveries,
    "stream_gaps": stream_gaps,
    "stream_lag": stream_lag,
    "stream_orphans": stream_orphans,
    "stream_collisions": stream_collisions,
    "stream_null_shares": stream_null_shares,
    "stream_guarded": stream_guarded,
    "stream_accuracy": _kept_report("accuracy_by_algorithm"),
    "stream_parse_quality": _kept_report("parse_quality"),
    "stream_hops": stream_hops,
    "stream_quarantine": stream_quarantine,
    "stream_fanout": stream_fanout,
    "stream_fanout_timing": stream_fanout_timing,
}
