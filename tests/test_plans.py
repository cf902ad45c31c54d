"""What the plans look like: scans, shuffles and skew."""

import re

import pytest
from messages import executed_of, optimized_of
from pyspark.sql import functions as F

from notice_lake.operators import checks, intervals, sequences
from notice_lake.operators.first_seen import first_seen
from notice_lake.operators.layers import dimension, fact, silver
from notice_lake.operators.typed import typed_notice
from notice_lake.plans import reports
from notice_lake.schemas import ARRIVAL_ORDER
from notice_lake.registry.queries import QUERIES
from notice_lake.sources import scratch, synthetic
from notice_lake.sources.synthetic import notices


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Stored layers, as reports meet them."""
    folder = tmp_path_factory.mktemp("layers")

    def store(df, name):
        df.write.parquet(str(folder / name))
        return spark.read.parquet(str(folder / name))

    layers = {"bronze": store(notices(spark, sf_dir), "bronze")}
    layers["silver"] = store(silver(layers["bronze"]), "silver")
    layers["fact"] = store(fact(layers["silver"]), "fact")
    for name, table in (
        ("timing", "dim_event_timing"),
        ("spatial", "dim_spatial_coords"),
        ("sun_moon", "dim_sun_moon_coords"),
    ):
        layers[name] = store(dimension(layers["silver"], table), name)
    return layers


def test_a_filter_on_a_parsed_field_does_not_repeat_the_split(stored):
    plan = optimized_of(reports.accuracy_by_algorithm(fact(silver(stored["bronze"]))))
    assert len(re.findall(r"split\(", plan)) == 1


def test_unused_fields_are_not_extracted(stored):
    plan = optimized_of(silver(stored["bronze"]).select("GRB_RA"))
    assert "GRB_RA" in plan and "MOON_DIST" not in plan and "array_join" not in plan


def test_reports_read_only_their_columns(stored):
    plan = executed_of(reports.accuracy_by_algorithm(stored["fact"]))
    assert "ReadSchema: struct<loc_algorithm:string,grb_error_deg:double>" in plan
    assert "PushedFilters: [IsNotNull(grb_error_deg)]" in plan


def test_dimensions_combine_before_the_shuffle(stored):
    plan = executed_of(dimension(stored["silver"], "dim_spatial_coords"))
    assert plan.index("min_by") < plan.index("Exchange") < plan.index("partial_min_by")


def test_top_k_is_not_a_full_sort(stored):
    for df in (
        reports.latest_raw(stored["bronze"]),
        reports.recent_bursts(stored["fact"], stored["spatial"]),
        reports.parsed_sample(stored["silver"]),
    ):
        plan = executed_of(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_snowflake_join_shuffles_the_fact_once(stored, session_conf):
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = reports.burst_sun_moon_context(stored["fact"], stored["spatial"], stored["sun_moon"])
    plan = executed_of(df)
    # spatial and sun/moon on the inner key, their result and the fact on the outer.
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("rangepartitioning") == 1


def test_narrow_events_are_dealt_before_they_become_texts(spark, sf_dir, tmp_path, session_conf):
    """A file of one row group is one task; its texts are made in as many as the session shuffles to."""
    session_conf("spark.sql.adaptive.enabled", "false")
    session_conf("spark.sql.shuffle.partitions", "5")
    synthetic.events(spark, sf_dir).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    rows = notices(spark, str(tmp_path)).groupBy(F.spark_partition_id()).agg(F.count("kafka_value").alias("n")).collect()
    assert len(rows) == 5 and max(r.n for r in rows) < 2 * min(r.n for r in rows)
    streamed = synthetic.notices_from(synthetic.events_stream(spark, sf_dir))
    assert "RepartitionByExpression" in streamed._jdf.queryExecution().analyzed().toString()


def test_typed_columns_stay_out_of_one_whole_stage_method(stored):
    """A projection with a higher-order function is compiled in several methods."""
    plan = executed_of(typed_notice(stored["silver"]))
    assert re.search(r"^(\+- |   )*Project .*transform\(array\(GRB_RA", plan, re.M)


def test_line_ends_are_replaced_where_there_are_some(stored):
    """A text without a carriage return and a segment of one line are only searched."""
    plan = optimized_of(silver(stored["bronze"]).select("GRB_RA"))
    assert re.search(r"CASE WHEN Contains\(replace\(kafka_value[^\r]*\r\) THEN rtrim\(", plan)
    assert re.search(r"CASE WHEN Contains\([^\n]*\n\) THEN replace\(", plan)


def test_values_are_made_for_lost_segments_only(stored):
    plan = optimized_of(silver(stored["bronze"], rescued=True).select("rescued_fields"))
    assert plan.index("transform(filter(sequence(") > 0 and "array_except(" in plan


def test_blocks_of_offsets_take_no_texts(spark):
    """The window that finds undelivered offsets sorts keys; texts come by one shuffle of their own."""
    schema = "kafka_key string, kafka_value string, kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp"
    rows = spark.createDataFrame([("k", "v", "t", 0, 1, None)], schema)
    index = spark.createDataFrame([], intervals.index_schema(rows.schema["kafka_timestamp"].dataType))
    plan = optimized_of(intervals.undelivered(rows, index))
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [max(" in line)
    assert not any("kafka_value" in line for line in lines[window : window + 4])


def scans(df):
    return len(re.findall(r"FileScan", executed_of(df).split("== Initial Plan ==")[0]))


def test_sequence_windows_run_inside_blocks(spark, sf_dir):
    """Rows meet in blocks; only block summaries meet per feed partition."""
    for check in (sequences.offset_gaps, sequences.late_messages):
        df = check(synthetic.damaged(spark, sf_dir))
        specs = re.findall(r"windowspecdefinition\(kafka_topic#\d+, kafka_partition#\d+, (\w+)", optimized_of(df))
        assert "_block" in specs
    bronze = notices(spark, sf_dir)
    assert scans(sequences.offset_gaps(bronze)) == 1
    assert scans(sequences.late_messages(bronze)) == 2


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_hot_key_is_split_by_the_join(spark, session_conf, how):
    """A third of the fact under one key: AQE cuts its partition into several tasks."""
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        session_conf(name, value)
    key = F.when(F.col("id") % 3 == 0, 42).otherwise(F.col("id").cast("int") % 997)
    facts = spark.range(0, 60000, 1, 8).select(
        key.alias("timing_sk"), F.col("id").alias("trigger_num"), F.lit(1).alias("record_num"),
        F.lit("t").alias("kafka_topic"), F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"), F.timestamp_seconds("id").alias("kafka_timestamp"),
        F.lit(1.0).alias("grb_error_deg"), F.lit("a").alias("loc_algorithm"),
        F.lit("u").alias("location_url"),
    )
    dims = spark.range(997).select(
        F.col("id").cast("int").alias("timing_sk"), F.lit("d").alias("grb_date_raw"), F.lit("t").alias("grb_time_raw")
    )
    if how == "left":
        df = reports.fact_with_timing(facts, dims)
        expected = 60000
    else:
        facts = facts.withColumnRenamed("timing_sk", "spatial_sk")
        dims = dims.selectExpr(
            "timing_sk AS spatial_sk", "grb_date_raw AS right_ascension",
            "grb_date_raw AS declination", "grb_time_raw AS galactic_coords",
        )
        df = reports.recent_bursts(facts, dims, n=100_000)
        expected = 60000
    assert len(df.collect()) == expected
    assert "skew=true" in executed_of(df)


@pytest.mark.parametrize("name", ["fact_with_timing", "recent_bursts", "fact_own_sun_moon"])
def test_registered_joins_split_a_hot_key(spark, sf_dir, session_conf, monkeypatch, name):
    """A third of the feed without payload, so under one key: the join in its registered form is split."""
    feed = spark.range(0, 60_000, 1, 8).withColumns(
        {
            "event_id": F.col("id"), "ts": F.timestamp_seconds("id").cast("timestamp_ntz"),
            "user_id": F.col("id") % 89, "event_type": F.lit("click"),
        }
    )
    rows = synthetic.notices_from(feed.drop("id"))
    value = F.when(F.col("kafka_offset") % 3 > 0, F.col("kafka_value"))
    hot = rows.withColumn("kafka_value", value)
    monkeypatch.setattr(synthetic, "notices", lambda *_: hot)
    for option, setting in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        session_conf(option, setting)
    df = QUERIES[name](spark, sf_dir)
    found = df.collect()
    assert len(found) == (50 if name == "recent_bursts" else 60_000)
    assert "skew=true" in executed_of(df)
    scratch.release(spark)


def test_first_seen_of_a_hot_key_leaves_one_row_per_task(spark):
    rows = spark.range(0, 10000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 0, id) AS k", "id AS v", "timestamp_seconds(id) AS kafka_timestamp",
        "'t' AS kafka_topic", "0 AS kafka_partition", "id AS kafka_offset",
    )
    found = first_seen(rows, "k", ARRIVAL_ORDER)
    assert found.filter("k = 0").first().v == 0
    assert found.count() == rows.select("k").distinct().count()
    assert "partial_min_by" in executed_of(first_seen(rows, "k", ARRIVAL_ORDER))


def test_reference_checks_count_before_they_join(stored, session_conf):
    """A parent too large to broadcast meets one counted row per key.

    (With a broadcast parent Catalyst joins first, which then needs no shuffle.)
    """
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = executed_of(checks.orphan_keys(stored["fact"], "timing_sk", stored["timing"], "timing_sk"))
    assert plan.index("Join") < plan.index("partial_count")


def test_reports_equal_plain_sql_on_the_same_tables(spark, stored):
    """An analyst's SQL over the stored layers gives what the report functions give."""
    for name in ("fact", "timing", "spatial", "sun_moon"):
        stored[name].createOrReplaceTempView(f"v_{name}")
    timing = spark.sql(
        "SELECT f.trigger_num, f.record_num, t.grb_date_raw, t.grb_time_raw, f.grb_error_deg,"
        " f.loc_algorithm FROM v_fact f LEFT JOIN v_timing t ON f.timing_sk = t.timing_sk"
    )
    report = reports.fact_with_timing(stored["fact"], stored["timing"])
    assert timing.exceptAll(report).isEmpty() and report.exceptAll(timing).isEmpty()
    context = spark.sql(
        "SELECT f.trigger_num, f.kafka_timestamp, s.right_ascension, s.declination,"
        " s.galactic_coords, m.sun_position, m.moon_position, m.moon_illumination,"
        " f.sun_dist_deg, f.moon_dist_deg FROM v_fact f JOIN v_spatial s"
        " ON f.spatial_sk = s.spatial_sk LEFT JOIN v_sun_moon m ON s.sun_moon_sk = m.sun_moon_sk"
    )
    report = reports.burst_sun_moon_context(stored["fact"], stored["spatial"], stored["sun_moon"])
    assert context.exceptAll(report).isEmpty() and report.exceptAll(context).isEmpty()
