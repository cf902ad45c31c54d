"""Streams that stop, lag of streams, and positions near each other."""

from __future__ import annotations

import json
import math
import random
from collections import Counter

import pytest
from messages import executed_of
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from notice_lake.operators.near import near_positions
from notice_lake.sources.tables import read_files
from notice_lake.streaming import guard, progress
from notice_lake.streaming.guard import Limits
from notice_lake.streaming.hops import append_to_files

SCHEMA = "n long, v int"
CHECKS = {"has_v": "v IS NOT NULL", "small": "v < 100"}


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def inbox(spark, tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()

    def deliver(k, bad, rows=20):
        made = [(100 * k + i, None if i < bad else 1) for i in range(rows)]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        return made

    yield deliver, str(folder)


def guarded(spark, tmp_path, folder, limits, action="warn"):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = read_files(spark, folder, schema=schema, streaming=True, max_files_per_trigger=1)
    query = guard.start_guarded(
        stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), expectations=CHECKS, limits=limits, action=action
    )
    query.awaitTermination()
    return query


def test_stream_stops_at_a_share_and_stays_stopped(spark, inbox, tmp_path):
    deliver, folder = inbox
    out, limits = str(tmp_path / "out"), Limits({"has_v": 0.25}, batches=2, min_rows=30)
    schema = spark.createDataFrame([], SCHEMA).schema
    assert guard.read_rows(spark, out, schema).count() == 0
    # The first batch alone is below min_rows, however bad; over two batches 10 of 40 are just at the limit.
    good = deliver(0, bad=10)
    guarded(spark, tmp_path, folder, limits)
    good += deliver(1, bad=0)
    guarded(spark, tmp_path, folder, limits)
    assert bag(guard.read_rows(spark, out, schema)) == Counter(good)
    # The share is taken over the batch before a restart as well: 11 of 40.
    stopped = deliver(2, bad=11)
    for _ in range(2):
        with pytest.raises(Exception, match="has_v: 11 of 40 rows, limit 0.25"):
            guarded(spark, tmp_path, folder, limits)
        assert bag(guard.read_rows(spark, out, schema)) == Counter(good)
    found = {tuple(r) for r in guard.read_breaches(spark, out).where("expectation = 'has_v'").collect()}
    assert found == {(0, "has_v", 20, 10, 0.5, True), (1, "has_v", 20, 0, 0.0, True), (2, "has_v", 20, 11, 0.55, False)}
    guard.accept(spark, out, 2)
    guarded(spark, tmp_path, folder, limits)
    assert bag(guard.read_rows(spark, out, schema)) == Counter(good + stopped)
    # An accepted batch counts on: 11 + 0 of 40 stops the next one, and a higher limit lets it go on.
    last = deliver(3, bad=0)
    with pytest.raises(Exception, match="batch 3"):
        guarded(spark, tmp_path, folder, limits)
    guarded(spark, tmp_path, folder, Limits({"has_v": 0.5}, batches=2))
    assert bag(guard.read_rows(spark, out, schema)) == Counter(good + stopped + last)


def test_dropped_rows_count_and_other_expectations_only_warn(spark, inbox, tmp_path):
    deliver, folder = inbox
    made = deliver(0, bad=5)
    guarded(spark, tmp_path, folder, Limits({"small": 0.5}), action="drop")
    out = str(tmp_path / "out")
    kept = guard.read_rows(spark, out, spark.createDataFrame([], SCHEMA).schema)
    assert bag(kept) == Counter(r for r in made if r[1] is not None)
    # An unknown outcome is a breach.
    assert {(r.expectation, r.failed) for r in guard.read_breaches(spark, out).collect()} == {("has_v", 5), ("small", 5)}
    with pytest.raises(ValueError, match="no such expectation"):
        guard.start_guarded(kept, out, "c", expectations=CHECKS, limits=Limits({"other": 0.1}))


def report(at, batch, sources, query="q"):
    texts = [{"description": "feed", "numInputRows": 1, "startOffset": s, "endOffset": e, "latestOffset": latest} for s, e, latest in sources]
    return {"id": query, "runId": "r", "name": None, "batchId": batch, "timestamp": f"2024-05-01T{at}.000Z", "sources": texts}


def test_lag_and_stalls_of_reported_offsets(spark, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    reports = [
        report("10:00:00", 0, [(None, {"a": {"0": 5, "1": 2}}, {"a": {"0": 9, "1": 2}})]),
        report("10:01:00", 1, [({"a": {"0": 5, "1": 2}}, {"a": {"0": 9, "1": 2}}, {"a": {"0": 20, "1": 2}, "b": {"0": 4}})]),
        # Idle: the batch number again, the feed went on.
        report("10:09:00", 1, [({"a": {"0": 9, "1": 2}}, {"a": {"0": 9, "1": 2}}, {"a": {"0": 30, "1": 2}, "b": {"0": 4}})]),
        # A file source, as number and as text; a source that says nothing.
        report("10:00:00", 4, [({"logOffset": 3}, {"logOffset": 4}, {"logOffset": 7}), ("1", "2", None), (None, None, None)], "files"),
    ]
    for r in (*reports, reports[1]):  # a report written again replaces itself
        log.write(r)
    triggers = progress.read_triggers(spark, log.folder)
    assert triggers.count() == 6
    lag = progress.live_lag(progress.offsets(triggers))
    found = {tuple(r)[:4] + (r.end_offset, r.latest_offset, r.lag, r.unmoved_since and r.unmoved_since.minute) for r in lag.collect()}
    assert found == {
        ("q", 0, "a", 0, 9, 30, 21, 1),
        ("q", 0, "a", 1, 2, 2, 0, 0),
        ("q", 0, "b", 0, None, 4, 4, None),
        ("files", 0, None, None, 4, 7, 3, 0),
        ("files", 1, None, None, 2, 2, 0, 0),
    }
    stalled = lambda patience: {(r.query_id, r.kafka_topic, r.kafka_partition) for r in progress.stalled(lag, patience).collect()}
    assert stalled("5 MINUTES") == {("q", "a", 0), ("q", "b", 0)}
    assert stalled("9 MINUTES") == {("q", "b", 0)}


def feed_of_two_partitions():
    """Made in a function, so that it travels to the Python workers as it is."""

    class Feed(DataSource):
        """A feed of two partitions, whose offsets have the shape of a broker's."""

        @classmethod
        def name(cls):
            return "two_partitions"

        def schema(self):
            return "n int"

        def simpleStreamReader(self, schema):  # noqa: N802
            class Reader(SimpleDataSourceStreamReader):
                def initialOffset(self):  # noqa: N802
                    return {"t": {"0": 0, "1": 0}}

                def read(self, start):
                    done = start["t"]["0"]
                    if done >= 30:
                        return iter([]), start
                    return iter([(i,) for i in range(10)]), {"t": {"0": done + 10, "1": start["t"]["1"] + 5}}

                def readBetweenOffsets(self, start, end):  # noqa: N802
                    return iter([(i,) for i in range(10)])

                def commit(self, end):
                    pass

            return Reader()

    return Feed


def test_listener_writes_what_running_queries_report(spark, tmp_path):
    spark.dataSource.register(feed_of_two_partitions())
    log = progress.ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        query = append_to_files(
            spark.readStream.format("two_partitions").load(), str(tmp_path / "out"), str(tmp_path / "checkpoint"),
            trigger={"processingTime": "0 seconds"},
        )
        query.processAllAvailable()
        query.stop()
        log.catch_up(query)
    finally:
        spark.streams.removeListener(log)
    lag = progress.live_lag(progress.offsets(progress.read_triggers(spark, log.folder)))
    found = {(r.query_id, r.kafka_topic, r.kafka_partition, r.end_offset, r.lag) for r in lag.collect()}
    assert found == {(query.id, "t", 0, 30, 0), (query.id, "t", 1, 15, 0)}
    rows = progress.read_triggers(spark, log.folder).agg({"rows": "sum"}).first()[0]
    assert rows == sum(json.loads(p.json)["numInputRows"] for p in query.recentProgress)


def plain_angle(a, b):
    (r1, d1), (r2, d2) = [tuple(math.radians(x) for x in p) for p in (a, b)]
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((r2 - r1) / 2) ** 2
    return math.degrees(2 * math.asin(min(1.0, math.sqrt(h))))


@pytest.mark.parametrize("radius", [0.5, 7.0, 44.0, 91.0, 180.0])
def test_near_positions_equal_all_pairs(spark, radius):
    rng = random.Random(radius)
    some = [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(60)]
    around = [(rng.choice([0.0, 359.9, 0.2, 180.0]) + rng.uniform(0, 0.09), rng.choice([-90, -89.8, 89.7, 0.0, 45.0]) + rng.uniform(0, 0.2)) for _ in range(60)]
    poles = [(0.0, 90.0), (200.0, 90.0), (10.0, -90.0), (0.0, 0.0), (359.999999, 0.0), (120.0, 7.0), (120.0, 0.0)]
    points = [*some, *around, *poles, *poles[:3]]
    rows = [(ra, dec, True) for ra, dec in points] + [(None, 1.0, False), (400.0, 0.0, False)]
    typed = spark.createDataFrame(rows, "ra_deg double, dec_deg double, position_valid boolean")
    near = near_positions(typed, radius)
    assert not any(x in executed_of(near) for x in ("CartesianProduct", "NestedLoop"))
    times = Counter(points)
    different = sorted(times)
    expected = {
        (*a, times[a], *b, times[b])
        for i, a in enumerate(different) for b in different[i + 1 :] if plain_angle(a, b) <= radius
    }
    found = [tuple(r) for r in near.collect()]
    assert {r[:-1] for r in found} == expected and len(found) == len(expected)
    assert all(abs(r[-1] - plain_angle(r[0:2], r[3:5])) < 1e-9 for r in found)


def test_near_positions_of_nothing_and_of_no_radius(spark):
    empty = spark.createDataFrame([], "ra_deg double, dec_deg double, position_valid boolean")
    assert near_positions(empty, 3.0).count() == 0
    for radius in (0, -1, 181):
        with pytest.raises(ValueError, match="radius"):
            near_positions(empty, radius)
