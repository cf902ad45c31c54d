import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from notice_lake.operators.layers import DIMENSIONS, dimension, fact, silver
from notice_lake.operators.quality import NOTICE_EXPECTATIONS, expect
from notice_lake.schemas import BRONZE, GOLD, SILVER, contract
from notice_lake.sources.synthetic import irregular, notices
from notice_lake.sources.tables import comment_on, create_table, read_files, read_table
from notice_lake.streaming import fan_out, hops, segments

ALGO = "sha256"


def same_rows(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def feed(spark, sf_dir, tmp_path_factory):
    """Two rounds of message files, in the bronze contract."""
    folder = tmp_path_factory.mktemp("feed")
    columns = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BRONZE]
    all_rows = notices(spark, sf_dir).selectExpr(*columns)
    early, late = all_rows.filter("kafka_offset < 150"), all_rows.filter("kafka_offset >= 150")
    early.repartition(3).write.parquet(str(folder / "round1"))
    late.repartition(2).write.parquet(str(folder / "round2"))
    return folder


class Feed:
    """A directory that message files arrive in."""

    def __init__(self, feed, path):
        self.feed, self.path = feed, path
        path.mkdir()

    def deliver(self, name):
        for source in sorted((self.feed / name).glob("*.parquet")):
            (self.path / f"{name}-{source.name}").write_bytes(source.read_bytes())

    def stream(self, spark):
        return read_files(
            spark, str(self.path), schema=BRONZE, streaming=True, max_files_per_trigger=1
        )

    def batch(self, spark):
        return spark.read.schema(BRONZE).parquet(str(self.path))


@pytest.fixture
def inbox(feed, tmp_path):
    return Feed(feed, tmp_path / "inbox")


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_chained_hops_with_a_restart_equal_the_batch(spark, inbox, tmp_path):
    silver_path, fact_path = str(tmp_path / "silver"), str(tmp_path / "fact")

    def go():
        run(hops.append_to_files(silver(inbox.stream(spark)), silver_path, str(tmp_path / "c1")))
        notices_stream = read_files(spark, silver_path, schema=SILVER, streaming=True)
        run(hops.append_to_files(fact(notices_stream, algo=ALGO), fact_path, str(tmp_path / "c2")))

    inbox.deliver("round1")
    go()
    inbox.deliver("round2")
    go()
    batch = silver(inbox.batch(spark))
    assert same_rows(spark.read.parquet(silver_path), batch)
    assert same_rows(spark.read.parquet(fact_path), fact(batch, algo=ALGO))


def test_new_checkpoint_reprocesses_from_the_start(spark, inbox, tmp_path):
    inbox.deliver("round1")
    for attempt in ("a", "b"):
        out = str(tmp_path / attempt)
        run(hops.append_to_files(silver(inbox.stream(spark)), out, str(tmp_path / f"c-{attempt}")))
        assert same_rows(spark.read.parquet(out), silver(inbox.batch(spark)))


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_state_store_dimension_remembers_keys_over_a_restart(
    spark, inbox, tmp_path, session_conf, partitions
):
    provider = "spark.sql.streaming.stateStore.providerClass"
    session_conf(provider, spark.conf.get(provider))
    session_conf("spark.sql.shuffle.partitions", partitions)
    out, checkpoint = str(tmp_path / "dim"), str(tmp_path / "c")
    for name in ("round1", "round2"):
        inbox.deliver(name)
        parsed = silver(inbox.stream(spark))
        before = spark.conf.get(provider)
        query = run(hops.start_dimension(parsed, "dim_spatial_coords", out, checkpoint, algo=ALGO))
        assert spark.conf.get(provider) == before
        states = [state for p in query.recentProgress for state in json.loads(p.json)["stateOperators"]]
        assert states and all(any(m.startswith("rocksdb") for m in state["customMetrics"]) for state in states)
    found = spark.read.parquet(out).select("spatial_sk")
    expected = dimension(silver(inbox.batch(spark)), "dim_spatial_coords", algo=ALGO)
    assert same_rows(found, expected.select("spatial_sk"))


def test_fan_out_over_many_batches(spark, inbox, tmp_path):
    folder, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for name in ("round1", "round2"):
        inbox.deliver(name)
        run(fan_out.start_fan_out(inbox.stream(spark), folder, checkpoint, algo=ALGO))
    batch = silver(inbox.batch(spark))
    assert same_rows(fan_out.read_output(spark, folder, "silver"), batch)
    assert same_rows(fan_out.read_output(spark, folder, "fact_notices"), fact(batch, algo=ALGO))
    for table, (_, key) in DIMENSIONS.items():
        found = fan_out.read_output(spark, folder, table, algo=ALGO)
        expected = dimension(batch, table, algo=ALGO)
        assert found.columns == expected.columns
        assert same_rows(found.select(key), expected.select(key))


def test_fan_out_in_one_batch_is_the_deterministic_batch_result(spark, inbox, tmp_path):
    inbox.deliver("round1")
    inbox.deliver("round2")
    folder = str(tmp_path / "out")
    stream = read_files(spark, str(inbox.path), schema=BRONZE, streaming=True)
    run(fan_out.start_fan_out(stream, folder, str(tmp_path / "c"), algo=ALGO))
    for table in DIMENSIONS:
        expected = dimension(silver(inbox.batch(spark)), table, algo=ALGO)
        assert same_rows(fan_out.read_output(spark, folder, table, algo=ALGO), expected)


def test_a_repeated_batch_replaces_its_first_attempt(spark, inbox, tmp_path):
    inbox.deliver("round1")
    rows = inbox.batch(spark)
    folder = str(tmp_path / "out")
    for batch_id in (0, 1, 1):
        part = rows.filter(f"kafka_partition % 2 = {batch_id}")
        fan_out.write_batch(part, batch_id, folder=folder, algo=ALGO)
    assert same_rows(fan_out.read_output(spark, folder, "silver"), silver(rows))
    for table, (_, key) in DIMENSIONS.items():
        found = fan_out.read_output(spark, folder, table, algo=ALGO)
        assert same_rows(found.select(key), dimension(silver(rows), table, algo=ALGO).select(key))


def test_batches_are_covered_by_few_segments():
    for width in (2, 8):
        for n in range(200):
            parts = segments.covering(n, width)
            batches = [b for level, first in parts for b in range(first, first + width**level)]
            assert batches == list(range(n))
            assert len(parts) <= (width - 1) * max(len({level for level, _ in parts}), 1)
    assert len(segments.covering(8_640 * 365)) <= 7 * 8


def test_folders_read_per_batch_stay_few_over_many_batches(spark, inbox, tmp_path, monkeypatch):
    """Over many batches what a batch opens does not grow, and keys are written once."""
    inbox.deliver("round1")
    table, key = "dim_spatial_coords", "spatial_sk"
    parsed = silver(inbox.batch(spark)).cache()
    opened = []
    plain = segments.covering
    monkeypatch.setattr(segments, "covering", lambda n, *w: opened.append(plain(n, *w)) or plain(n, *w))
    folder = str(tmp_path / "out")
    for batch in range(32):
        part = parsed.filter(f"kafka_offset % 32 IN ({batch}, {(batch * 7 + 3) % 32})")
        fan_out.add_new_members(part, folder, table, batch)
    assert max(len(x) for x in opened) <= 7 + 5
    schema = contract(GOLD[table].schema)
    found = segments.read(spark, f"{folder}/{table}", schema, key, 32)
    expected = dimension(parsed, table).select(key)
    assert same_rows(found.select(key), expected)


def test_buckets_grow_with_the_level_and_look_ups_find_every_key(spark, tmp_path):
    folder, schema = str(tmp_path / "seg"), spark.createDataFrame([], "k bigint, v string").schema
    for batch in range(65):
        rows = spark.range(batch * 40, batch * 40 + 40, 1, 1).selectExpr("id AS k", "string(id) AS v")
        segments.write(rows, folder, batch)
        segments.merge(spark, folder, schema, "k", batch)
    assert segments.covering(65) == [(2, 0), (0, 64)]
    for level, parts in ((1, 32), (2, 64)):
        found = spark.read.parquet(segments.place(folder, level, 0))
        assert found.agg({segments.BUCKET: "max"}).first()[0] == parts - 1
    for batches in (3, 8, 65):
        whole = segments.read(spark, folder, schema, "k", batches)
        assert sorted(r["k"] for r in whole.collect()) == list(range(batches * 40))
        asked = spark.createDataFrame([(k, "") for k in (0, 7, 41, batches * 40 - 1)], schema)
        buckets = segments.with_bucket(asked, "k", segments.top_level(batches))
        touched = [r[0] for r in buckets.select(segments.BUCKET).distinct().collect()]
        near = segments.read(spark, folder, schema, "k", batches, touched)
        assert near.columns == ["k", "v"]
        seen = {r["k"] for r in near.collect()}
        assert {0, 7, 41, batches * 40 - 1} <= seen and len(seen) < 0.4 * batches * 40


def test_readers_take_finished_batches_only(spark, inbox, tmp_path, monkeypatch):
    inbox.deliver("round1")
    rows, folder = inbox.batch(spark), str(tmp_path / "out")
    for batch in range(3):
        fan_out.write_batch(rows.filter(f"kafka_offset % 4 = {batch}"), batch, folder=folder)
    assert fan_out.last_batch(spark, folder) == 2
    assert len(list((tmp_path / "out" / "done").glob("[0-9]*"))) <= 2

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(fan_out, "commit", stop)
    with pytest.raises(RuntimeError):
        fan_out.write_batch(rows.filter("kafka_offset % 4 = 3"), 3, folder=folder)
    finished = rows.filter("kafka_offset % 4 < 3")
    assert same_rows(fan_out.read_output(spark, folder, "bronze"), finished)
    assert same_rows(fan_out.read_output(spark, folder, "fact_notices"), fact(silver(finished)))
    for table, (_, key) in DIMENSIONS.items():
        found = fan_out.read_output(spark, folder, table)
        assert same_rows(found.select(key), dimension(silver(finished), table).select(key))


def test_a_batch_that_breaks_the_contract_is_refused(spark, inbox, tmp_path):
    inbox.deliver("round1")
    rows = inbox.batch(spark).withColumn("kafka_offset", F.col("kafka_offset").cast("string"))
    with pytest.raises(TypeError, match="kafka_offset"):
        fan_out.write_batch(rows, 0, folder=str(tmp_path / "out"))


def test_fan_out_with_quarantine(spark, sf_dir, tmp_path):
    columns = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BRONZE]
    rows = irregular(spark, sf_dir).selectExpr(*columns)
    folder = str(tmp_path / "out")
    fan_out.write_batch(rows, 0, folder=folder, quarantine=True)
    counts = {
        t: fan_out.read_output(spark, folder, t).count() for t in ("silver", "quarantine", "fact_notices")
    }
    assert counts["silver"] == rows.count()
    assert counts["silver"] == fan_out.read_output(spark, folder, "bronze").count()
    assert 0 < counts["quarantine"] < counts["silver"]
    kept = fan_out.read_output(spark, folder, "quarantine")
    assert kept.filter("kafka_value IS NULL AND parse_issue <> 'null payload'").isEmpty()
    texts = rows.select("kafka_partition", "kafka_offset", F.col("kafka_value").alias("sent"))
    assert kept.join(texts, ["kafka_partition", "kafka_offset"]).filter("NOT kafka_value <=> sent").isEmpty()
    assert counts["quarantine"] + counts["fact_notices"] == counts["silver"]


def test_a_hop_keeps_the_contract_of_its_table(spark, inbox, tmp_path):
    inbox.deliver("round1")
    parsed, out = silver(inbox.stream(spark)), str(tmp_path / "silver")
    with pytest.raises(TypeError, match="TITLE"):
        hops.append_to_files(parsed.drop("TITLE"), out, str(tmp_path / "c"), schema=SILVER)
    run(hops.append_to_files(parsed.withColumn("more", F.lit(1)), out, str(tmp_path / "c"), schema=SILVER))
    assert spark.read.parquet(out).columns == SILVER.names


def test_inspection_of_a_stream(spark, inbox):
    inbox.deliver("round1")
    assert same_rows(hops.inspect(silver(inbox.stream(spark))), silver(inbox.batch(spark)))


def test_declarative_graph_with_plain_decorators(spark, inbox, monkeypatch):
    """Every table of the graph is defined, under its contract, from the one above it."""
    from pyspark import pipelines

    from notice_lake.streaming import declarative

    tables = {}

    def table(*, name, comment, schema=None):
        return lambda make: tables.setdefault(name, (make, comment, schema))

    monkeypatch.setattr(pipelines, "table", table, raising=False)
    inbox.deliver("round1")
    source = inbox.stream(spark).selectExpr(
        "CAST(kafka_key AS BINARY) AS key", "CAST(kafka_value AS BINARY) AS value", "kafka_topic AS topic",
        "kafka_partition AS partition", "kafka_offset AS offset", "kafka_timestamp AS timestamp",
    )
    monkeypatch.setattr(declarative, "read_topic", lambda *_: source)

    class Streams:
        """A session whose stored streams are the graph's own tables."""

        readStream = type("R", (), {"table": staticmethod(lambda name: tables[name][0]())})

    declarative.define(Streams, {"subscribe": "topic"})
    assert set(tables) == set(declarative.TABLES)
    for name, (make, comment, schema) in tables.items():
        assert comment and make().isStreaming
        if schema is not None:
            assert make().schema.names == schema.names


def test_stream_into_a_catalog_table_and_on_from_there(spark, inbox, tmp_path):
    inbox.deliver("round1")
    spark.sql("CREATE SCHEMA IF NOT EXISTS hop_test")
    try:
        create_table(spark, "hop_test.notices", SILVER, comment="parsed")
        comment_on(spark, "hop_test.notices", "it's parsed")
        query = hops.append_to_table(
            silver(inbox.stream(spark)), "hop_test.notices", str(tmp_path / "c1")
        )
        run(query)
        assert same_rows(read_table(spark, "hop_test.notices"), silver(inbox.batch(spark)))
        onward = fact(read_table(spark, "hop_test.notices", streaming=True))
        run(hops.append_to_files(onward, str(tmp_path / "fact"), str(tmp_path / "c2")))
        assert spark.read.parquet(str(tmp_path / "fact")).count() == inbox.batch(spark).count()
    finally:
        spark.sql("DROP SCHEMA hop_test CASCADE")


def test_processing_time_trigger(spark, inbox, tmp_path):
    inbox.deliver("round1")
    out = str(tmp_path / "silver")
    query = hops.append_to_files(
        silver(inbox.stream(spark)), out, str(tmp_path / "c"), trigger=hops.every("1 second")
    )
    try:
        query.processAllAvailable()
        inbox.deliver("round2")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(out).count() == 1000


def test_expectations_are_observed_on_a_stream(spark, inbox, tmp_path):
    inbox.deliver("round1")
    checked = expect(silver(inbox.stream(spark)), NOTICE_EXPECTATIONS, action="drop", observe="rules")
    query = run(hops.append_to_files(checked, str(tmp_path / "s"), str(tmp_path / "c")))
    progress = [json.loads(p.json) for p in query.recentProgress]
    rows = sum(p["observedMetrics"]["rules"]["rows"] for p in progress if p.get("observedMetrics"))
    assert rows == inbox.batch(spark).count()


def test_rocksdb_is_for_the_queries_started_inside(spark, session_conf):
    name = "spark.sql.streaming.stateStore.providerClass"
    session_conf(name, "some.other.Provider")
    with hops.rocksdb_state(spark):
        assert spark.conf.get(name) == hops.ROCKSDB_PROVIDER
    assert spark.conf.get(name) == "some.other.Provider"


def test_rocksdb_is_set_for_the_session(spark, session_conf):
    name = "spark.sql.streaming.stateStore.providerClass"
    session_conf(name, spark.conf.get(name))
    hops.use_rocksdb_state(spark)
    assert spark.conf.get(name) == hops.ROCKSDB_PROVIDER
