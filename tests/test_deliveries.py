"""Intervals of delivered offsets, the stream that takes each delivery once, and state that forgets."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from messages import executed_of
from pyspark.sql import functions as F

from notice_lake.operators import intervals, sequences
from notice_lake.operators.layers import dimension, silver
from notice_lake.schemas import BRONZE
from notice_lake.sources.synthetic import notices
from notice_lake.sources.tables import read_files
from notice_lake.streaming import bounded, deliveries, fan_out, hops

DAY = datetime(2024, 5, 1)
SCHEMA = "kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, kafka_value string"


def feed(seed, n=400, top=300):
    rng = random.Random(seed)
    return [
        (rng.choice("ab"), rng.choice([0, 1]), rng.randrange(-20, top), DAY + timedelta(minutes=rng.randrange(5000)), f"v{rng.randrange(9)}")
        for _ in range(n)
    ]


def plain_intervals(rows):
    parts = {}
    for topic, part, offset, at, _ in rows:
        if offset is not None:
            parts.setdefault((topic, part), {}).setdefault(offset, []).append(at)
    out = set()
    for key, times in parts.items():
        offsets = sorted(times)
        starts = [o for o in offsets if o - 1 not in times]
        for first in starts:
            last = first
            while last + 1 in times:
                last += 1
            newest = max(t for o in range(first, last + 1) for t in times[o])
            out.add((*key, first, last, min(times[first]), newest))
    return out


@pytest.mark.parametrize("bits", [1, 3, 20])
def test_intervals_of_parts_merge_into_those_of_the_whole(spark, bits):
    rows = [*feed(bits), ("a", 0, None, DAY, "x"), (None, None, 7, DAY, "y")]
    rng = random.Random(bits)
    rng.shuffle(rows)
    whole = intervals.delivered(spark.createDataFrame(rows, SCHEMA), block_bits=bits)
    assert {tuple(r) for r in whole.collect()} == plain_intervals(rows)
    parts = [rows[:150], rows[100:260], rows[250:]]
    index = None
    for part in parts:
        own = intervals.delivered(spark.createDataFrame(part, SCHEMA), block_bits=bits)
        index = own if index is None else intervals.merged(index.unionByName(own))
    assert {tuple(r) for r in index.collect()} == plain_intervals(rows)


def test_holes_are_the_gaps_of_all_messages(spark):
    rows = feed(9, n=200)
    messages = spark.createDataFrame(rows, SCHEMA)
    found = intervals.holes(intervals.delivered(messages), "1 HOUR")
    gaps = sequences.offset_gaps(messages)
    assert sorted(found.select(*gaps.columns).collect()) == sorted(gaps.collect())
    newest = {}
    for topic, part, _, at, _ in rows:
        newest[topic, part] = max(at, newest.get((topic, part), at))
    opened = {(t, p, first): at for t, p, first, _, at, _ in plain_intervals(rows)}
    for r in found.collect():
        key = (r.kafka_topic, r.kafka_partition)
        assert r.opened == opened[*key, r.gap_end + 1]
        assert r.lost == (r.opened + timedelta(hours=1) < newest[key])


@pytest.mark.parametrize("bits", [1, 4, 20])
def test_undelivered_messages_equal_brute_force(spark, bits):
    old, new = feed(1, n=150), feed(2, n=300, top=400)
    new += [("a", 0, None, DAY, "x"), ("a", 0, None, DAY, "x"), ("new", 5, 10**12, DAY, "far"), (None, 0, 3, DAY, "y")]
    index = intervals.delivered(spark.createDataFrame(old, SCHEMA), block_bits=bits)
    left = intervals.undelivered(spark.createDataFrame(new, SCHEMA), index, block_bits=bits)
    assert not any(x in executed_of(left) for x in ("CartesianProduct", "NestedLoop"))
    known = {r[:3] for r in old}
    first = {}
    for r in new:
        if r[2] is not None and r[:3] not in known:
            first[r[:3]] = min(r, first.get(r[:3], r), key=lambda x: x[3:])
    expected = [*first.values(), *[r for r in new if r[2] is None]]
    assert sorted(map(str, map(tuple, left.collect()))) == sorted(map(str, expected))


def test_nothing_delivered_before_or_now(spark):
    rows = spark.createDataFrame(feed(3, n=50), SCHEMA)
    nothing = rows.limit(0)
    index = intervals.delivered(nothing)
    assert index.count() == 0 and intervals.holes(index, "1 DAY").count() == 0
    assert intervals.undelivered(rows, index).count() == rows.select("kafka_topic", "kafka_partition", "kafka_offset").distinct().count()
    assert intervals.undelivered(nothing, intervals.delivered(rows)).count() == 0


@pytest.fixture
def inbox(spark, sf_dir, tmp_path):
    """Files of a feed: each delivers some offsets, out of order, parts of it again and again."""
    columns = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BRONZE]
    messages = notices(spark, sf_dir).selectExpr(*columns).where("kafka_offset % 17 <> 3").cache()
    folder = tmp_path / "inbox"
    rounds = ["kafka_offset BETWEEN 100 AND 180", "kafka_offset < 120", "kafka_offset % 2 = 0", "kafka_offset > 90", "true"]

    def deliver(k):
        messages.where(rounds[k]).coalesce(1).write.mode("append").parquet(str(folder))

    folder.mkdir()
    yield messages, deliver, str(folder)
    messages.unpersist()


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_each_delivery_once_over_restarts_and_a_retried_batch(spark, inbox, tmp_path, monkeypatch):
    messages, deliver, folder = inbox
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def go():
        stream = read_files(spark, folder, schema=BRONZE, streaming=True, max_files_per_trigger=1)
        return deliveries.start_deliveries(stream, out, checkpoint)

    deliver(0)
    deliver(1)
    run(go())
    deliver(2)
    # The batch writes its tables and fails before it is marked as done.
    monkeypatch.setattr(fan_out, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        go().awaitTermination()
    monkeypatch.undo()
    seen = deliveries.read_messages(spark, out, BRONZE)
    assert seen.count() == messages.where("kafka_offset < 181").count()
    deliver(3)
    deliver(4)
    run(go())
    assert sorted(deliveries.read_messages(spark, out, BRONZE).collect(), key=str) == sorted(messages.collect(), key=str)
    index = deliveries.read_index(spark, out, BRONZE["kafka_timestamp"].dataType)
    holes = intervals.holes(index, "1 DAY")
    gaps = sequences.offset_gaps(messages)
    assert sorted(holes.select(*gaps.columns).collect()) == sorted(gaps.collect())
    # As many rows as holes and partitions, however many messages and deliveries.
    assert index.count() == gaps.count() + 4
    # Two indexes are kept.
    kept = [p.name for p in (tmp_path / "out" / "delivered").iterdir()]
    assert len(kept) == 2


def test_state_stays_bounded_over_many_batches(spark, sf_dir, tmp_path):
    columns = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BRONZE]
    batches, folder = 30, tmp_path / "inbox"
    messages = notices(spark, sf_dir).selectExpr(*columns).withColumn("_k", F.pmod(F.xxhash64("kafka_key"), F.lit(batches)))
    messages.cache()
    # Each batch has keys of its own, and the ones of the batch long before again.
    for k in range(batches):
        some = messages.where((F.col("_k") == k) | (F.col("_k") == k - 15)).drop("_k")
        some.coalesce(1).write.mode("append").parquet(str(folder))
    stream = read_files(spark, str(folder), schema=BRONZE, streaming=True, max_files_per_trigger=1)
    table, out = "dim_spatial_coords", str(tmp_path / "out")
    query = bounded.start_bounded_dimension(
        silver(stream), table, out, str(tmp_path / "checkpoint"), algo="sha256", remember="1 millisecond"
    )
    run(query)
    rows = [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if json.loads(p.json)["stateOperators"]]
    assert len(rows) >= batches
    found = bounded.read_dimension(spark, out, table, algo="sha256")
    expected = dimension(silver(messages.drop("_k")), table, algo="sha256")
    keys = ["spatial_sk", "right_ascension", "declination", "galactic_coords"]
    assert sorted(found.select(keys).collect()) == sorted(expected.select(keys).collect())
    # Forgetting works: state never held half of all keys and salts.
    total = found.count()
    assert 0 < max(rows) < total * int(spark.conf.get("spark.sql.shuffle.partitions")) / 2
    messages.unpersist()
