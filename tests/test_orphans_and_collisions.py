"""Orphans between two streams, collisions across batches, rescued values as VARIANT, joins of bucketed tables."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

import pytest
from messages import START, executed_of, message_table
from pyspark.sql import functions as F

from notice_lake.operators import rescued
from notice_lake.operators.layers import silver
from notice_lake.sources import bucketed
from notice_lake.sources.tables import read_files
from notice_lake.streaming import collisions, maintained, orphans

CHILD = "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp {clock}, k string"
PARENT = "k string, kafka_timestamp {clock}"
CLOCKS = ["timestamp", "timestamp_ntz"]


def at(minute):
    return START + timedelta(minutes=minute)


def children(spark, rows, clock="timestamp"):
    """(offset, minute, key)"""
    return spark.createDataFrame([("t", 0, o, None if m is None else at(m), k) for o, m, k in rows], CHILD.format(clock=clock))


def parents(spark, rows, clock="timestamp"):
    return spark.createDataFrame([(k, at(m)) for k, m in rows], PARENT.format(clock=clock))


class Feed:
    """Two file streams that get more files between runs of one query."""

    def __init__(self, spark, folder, clock="timestamp", **options):
        self.spark, self.folder, self.clock, self.options = spark, str(folder), clock, options

    def add(self, child_rows=(), parent_rows=()):
        children(self.spark, child_rows, self.clock).coalesce(1).write.mode("append").parquet(f"{self.folder}/c")
        parents(self.spark, parent_rows, self.clock).coalesce(1).write.mode("append").parquet(f"{self.folder}/p")

    def run(self):
        c = read_files(self.spark, f"{self.folder}/c", schema=children(self.spark, [], self.clock).schema, streaming=True)
        p = read_files(self.spark, f"{self.folder}/p", schema=parents(self.spark, [], self.clock).schema, streaming=True)
        query = orphans.start_orphans(c, p, "k", "k", f"{self.folder}/out", f"{self.folder}/checkpoint", **self.options)
        query.awaitTermination()
        assert query.exception() is None
        return {r["key_value"]: r["child_rows"] for r in orphans.read_orphans(self.spark, f"{self.folder}/out").collect()}


@pytest.mark.parametrize("clock", CLOCKS)
def test_orphans_appear_when_the_watermark_passes(spark, tmp_path, clock, session_conf):
    session_conf("spark.sql.session.timeZone", "America/New_York")
    feed = Feed(spark, tmp_path, clock)
    feed.add([(0, 0, "a"), (1, 0, "b"), (2, 0, None), (3, 1, "b"), (4, None, "b")], [("a", 5)])
    assert feed.run() == {}  # the dimension row of b may still come
    feed.add([(5, 30, "c")], [("x", 30)])
    assert feed.run() == {}
    feed.add([(6, 100, "a")], [("c", 40), ("x", 100)])
    assert feed.run() == {"b": 2}  # the wait of an hour is over; c came after its child row, in time
    feed.add([(7, 300, "d")], [("x", 300)])
    assert feed.run() == {"b": 2, "a": 1}  # a was seen 95 minutes before its last child: forgotten


def test_stored_dimension_decides_what_the_state_has_forgotten(spark, tmp_path):
    def known(session):
        return session.read.schema(PARENT.format(clock="timestamp")).parquet(f"{tmp_path}/p").select("k")

    feed = Feed(spark, tmp_path, known=known)
    feed.add([(0, 0, "a"), (1, 0, "b")], [("a", 0)])
    feed.run()
    feed.add([(2, 100, "a"), (3, 101, "b")], [("x", 100)])
    feed.run()
    feed.add([(4, 300, "z")], [("x", 300)])
    assert feed.run() == {"b": 2}
    assert feed.run() == {"b": 2}  # nothing new


def test_rows_of_a_hot_key_spread_over_state_partitions(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(i, 0, "hot") for i in range(400)], [("x", 0)])
    feed.run()
    feed.add([(400, 300, "other")], [("x", 300)])
    assert feed.run() == {"hot": 400}
    salts = children(spark, [(i, 0, "hot") for i in range(400)]).select(
        F.pmod(F.xxhash64("kafka_topic", "kafka_partition", "kafka_offset"), F.lit(8)).alias("s")
    )
    assert max(r["count"] for r in salts.groupBy("s").count().collect()) < 100


def test_collision_across_batches_is_found_once(spark, tmp_path):
    folder, columns = str(tmp_path / "out"), "sk int, a string, b string"
    batches = [
        [(1, "x", "y"), (2, "x", None), (3, "p", "q"), (None, None, None)],
        [(1, "x", "y"), (2, "x", None)],
        [(2, None, "x"), (3, "p", "q")],  # 2 now stands for two natural keys, with NULL in unlike places
        [],
        [(4, "ab", "c"), (4, "a", "bc")],
    ]
    seen = []
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, columns)
        for _ in range(2 if n == 2 else 1):  # a retried batch
            collisions.write_batch(df, n, folder=folder, key="sk", natural=("a", "b"))
        seen += rows
        whole = spark.createDataFrame(seen, columns)
        found = collisions.read_collisions(spark, folder, whole, key="sk", natural=("a", "b"))
        expected = {k: len({r[1:] for r in seen if r[0] == k}) for k in {r[0] for r in seen}}
        expected = {(k, v, sum(r[0] == k for r in seen)) for k, v in expected.items() if v > 1}
        assert {tuple(r) for r in found.collect()} == expected
    assert {r["sk"] for r in collisions.read_suspects(spark, folder, "sk").collect()} == {2, 4}


def test_digests_are_a_row_per_key_not_per_message(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.range(3000).selectExpr("int(id % 3) AS sk", "string(id % 3) AS a")
    for n in range(9):
        collisions.write_batch(rows, n, folder=folder, key="sk", natural=("a",))
    report = collisions.report("sk")
    kept = maintained.read(spark, f"{folder}/collisions", report, 9)
    assert {(r["sk"], r["row_count"]) for r in kept.collect()} == {(k, 9000) for k in range(3)}
    assert sum(spark.read.parquet(f).count() for f in set(kept.inputFiles())) == 6  # two segments cover nine batches


def values_of(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return df.select("t", F.expr("1").alias("_"), rescued.variant_value(F.col("t")).alias("v"))


def test_values_are_numbers_only_if_they_read_back(spark):
    texts = ["5", "-1.5", "1e3", "007", "+1", "true", "null", "", '{"a": 1}', "1e999", "NaN", " 5", None, "12345678901234567890123456789012345678901234"]
    kinds = {r[0]: r[1] for r in values_of(spark, texts).select("t", F.schema_of_variant("v")).collect()}
    text = {"007", "+1", "null", "", '{"a": 1}', "NaN", " 5"}
    assert {t for t, k in kinds.items() if k == "STRING"} >= text
    assert kinds["5"] == "BIGINT" and kinds["true"] == "BOOLEAN" and kinds["-1.5"].startswith("DECIMAL") and kinds["1e3"] == "DOUBLE"
    assert kinds[None] is None and kinds["1e999"] in ("STRING", "DOUBLE")


def test_new_labels_become_typed_columns_without_the_texts(spark, tmp_path):
    messages = message_table(
        spark,
        ["TITLE: a\nRATE: 5\nRATE: 7\nNOTE: x", "TITLE: b\nRATE: 2.5", "TITLE: c\nNOTE: 9", None, "TITLE: d", ""],
    )
    entries = rescued.variant_entries(silver(messages, rescued=True))
    entries.write.parquet(str(tmp_path / "entries"))
    kept = spark.read.schema(entries.schema).parquet(str(tmp_path / "entries"))
    found = {r["label"]: tuple(r)[1:] for r in rescued.discovered(kept).collect()}
    assert found["RATE"][:2] == (3, 2) and found["RATE"][2].startswith("DECIMAL")
    assert found["NOTE"] == (2, 2, "VARIANT")  # a text and a number
    columns = {"rate": ("RATE", "double"), "note": ("NOTE", "string"), "none": ("NONE", "int"), "bad": ("NOTE", "int")}
    typed = {r["kafka_offset"]: (r["rate"], r["note"], r["none"], r["bad"]) for r in rescued.typed_columns(kept, columns).collect()}
    assert typed[0] == (5.0, "x", None, None) and typed[1] == (2.5, None, None, None)
    assert typed[2] == (None, "9", None, 9) and typed[3] == typed[4] == typed[5] == (None,) * 4


def facts(spark, n=3000):
    """A third of the rows hold one key, a tenth none."""
    return spark.range(n).selectExpr(
        "'t' AS kafka_topic", "int(id % 4) AS kafka_partition", "id AS kafka_offset",
        "CASE WHEN id % 10 = 9 THEN NULL WHEN id % 3 = 0 THEN 'hot' ELSE string(id % 400) END AS k",
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_bucketed_join_moves_no_row(spark, session_conf, how):
    session_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    fact = facts(spark)
    dim = spark.range(0, 500, 2).selectExpr("string(id) AS k", "id AS v").union(spark.createDataFrame([("hot", -1)], "k string, v long"))
    pair = bucketed.write_pair(fact, dim, "k", buckets=8, salts=8)
    try:
        found = bucketed.joined(spark, pair, how)
        rows = Counter((r["kafka_offset"], r["k"], r["v"]) for r in found.collect())
        assert rows == Counter((r["kafka_offset"], r["k"], r["v"]) for r in fact.join(dim, "k", how).collect())
        plan = executed_of(found)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert pair.hot == ("hot",)
        stored = spark.table(pair.fact)
        sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
        assert max(sizes) <= 3 * 3000 / 8  # without salts the hot bucket would hold 900 rows and its share of the others
        assert len(set(stored.inputFiles())) <= 8
    finally:
        bucketed.drop_pair(spark, pair)


def test_pair_without_rows_or_hot_keys(spark):
    dim = spark.createDataFrame([("a", 1)], "k string, v long")
    for n in (0, 1):
        pair = bucketed.write_pair(facts(spark, n), dim, "k")
        assert bucketed.joined(spark, pair).count() == n
        bucketed.drop_pair(spark, pair)
